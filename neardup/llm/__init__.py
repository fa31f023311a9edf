"""Operations of a training-data pipeline over document, page and conversation tables.

Nothing outside this subpackage imports it.
"""
