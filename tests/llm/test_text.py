"""Personal data, pieces, chat, archives and fingerprints."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from neardup.llm import chat, fingerprint, pieces, pii, warc
from neardup.llm.queries import MODEL_PATH, QUOTED, llm_queries
from tests.llm.fixtures import LONG, documents, edge_texts, with_clashes, words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            yield kind, *m.span()


def test_base_spans_equal_the_patterns():
    draw = random.Random(0)
    for _ in range(20_000):
        text = "".join(draw.choice("ab@..11234567890+- ()%é") for _ in range(draw.randrange(60)))
        assert [s[:3] for s in pii.spans_of(text) if s[4]] == list(base_spans(text))


def test_checksums_context_and_masking():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    near = pii.spans_of("my amex card 378282246310005")
    assert [s[0] for s in near] == ["card"] and not near[0][4]
    assert pii.spans_of("number 378282246310005") == []
    low, high = pii.spans_of("version 1.2.3.4")[0][3], pii.spans_of("server 1.2.3.4")[0][3]
    assert low < pii.PRIOR["ip"] < high
    assert pii.masked("to a.b@c.de or 1.2.3.4") == "to [EMAIL] or [IP]"
    # Long runs take linear time.
    assert pii.spans_of("1" * 200_000 + "a" * 200_000 + "@" * 1000) == []


def test_account_numbers_end_where_the_country_says():
    number = "DE89 3704 0044 0532 0130 00"
    for text in (
        f"IBAN {number} BIC COBADEFFXXX", f"{number} 2024 invoice", f"{number} 12 EUR", f"{number}é",
        f"AB12 {number} X", f"{number} GB82 WEST 1234 5698 7654 32", f"EUR 10 {number}.",
        "DE89370400440532013000 2024 invoice", "NO93 8601 1117 947 OSLO", f"XX12 3456 {number} BIC",
    ):
        spans = [text[a:b] for kind, a, b, *_ in pii.spans_of(text) if kind == "iban"]
        want = [x for x in (number, "DE89370400440532013000", "NO93 8601 1117 947") if x in text]
        assert spans[:1] == want and len(spans) == 1 + ("GB82" in text), text
    assert pii.masked(f"IBAN {number} BIC COBADEFFXXX") == "IBAN [IBAN] BIC COBADEFFXXX"
    # Without a known country each end of a word counts.
    body = "ZZ{:02d}5000 1234 5678 901"
    other = next(x for i in range(98) if pii.mod97((x := body.format(i)).replace(" ", "")))
    assert pii.masked(f"to {other} REF A") == "to [IBAN] REF A"
    assert pii.spans_of("DE88 3704 0044 0532 0130 00 BIC") == [] and pii.spans_of("xDE89370400440532013000") == []
    # What follows without a space belongs to the word: no number ends there.
    assert pii.spans_of("DE89370400440532013000ABCx") == []
    assert pii.spans_of("AB12 " * 50_000) == []


def test_pii_edge_cases(spark):
    docs = with_clashes(documents(spark, edge_texts()))
    found = pii.find_pii(docs).collect()
    assert sorted(len(r.spans) for r in found) == [0] * 10 + [1, 1]
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    by_id = {r.doc_id: r.text for r in masked.where("doc_id is not null").collect()}
    assert by_id[3] is None and by_id[9].endswith("[EMAIL]") and by_id[6] == LONG
    assert pii.mask_pii(docs.where("false")).count() == 0


@pytest.fixture(scope="module")
def own():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)


def test_pieces_equal_the_library(own):
    with open(MODEL_PATH, "rb") as f:
        encoder = pieces.Encoder(f.read(), 2, True)
    draw = random.Random(1)
    parts = ["a", " ", "  ", "▁", "<s>", "<0x0A>", "\n", "é", "梦", "😀", "th", " the", "​"]
    texts = ["", *("".join(draw.choice(parts) for _ in range(draw.randrange(25))) for _ in range(3000))]
    ids, same = encoder.encode(texts)
    assert same.all() and ids.to_pylist() == own.encode(texts)
    assert encoder.decode(ids).to_pylist() == own.decode(own.encode(texts))
    whole = encoder._whole(texts)[0]  # without the split at words
    assert whole.to_pylist() == ids.to_pylist()


def test_a_unigram_model_is_rebuilt():
    def message(*fields):
        out = b""
        for number, wire, value in fields:
            out += bytes([number << 3 | wire])
            out += bytes([len(value)]) + value if wire == 2 else value
        return out

    import struct

    def piece(text, score, kind):
        return message((1, 2, text.encode()), (2, 5, struct.pack("<f", score)), (3, 0, bytes([kind])))

    every = [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2, 1), ("b", -2, 1), ("▁ab", -1, 1)]
    data = b"".join(message((1, 2, piece(*p))) for p in every)
    data += message((2, 2, message((3, 0, b"\x01")))) + message((3, 2, message((4, 0, b"\x00"))))
    model = pieces.parse_model(data)
    assert model.kind == pieces.UNIGRAM and not model.squeeze_spaces and model.pieces[4][0] == "▁ab"
    encoder = pieces.Encoder(data)
    assert encoder.encode(["ab ab", "ba", ""])[0].to_pylist() == [[4, 4], [1, 3, 2], []]
    with pytest.raises(ValueError):
        pieces.parse_model(b"\x0a\xff")


def test_pieces_edge_cases(spark, own):
    docs = with_clashes(documents(spark, edge_texts()))
    encoded = pieces.encode(docs, MODEL_PATH, output_col="ids", parity_col="same")
    back = pieces.decode(encoded, MODEL_PATH, "ids", "text_again")
    assert back.columns == [*docs.columns, "ids", "same", "text_again"]
    for r in back.collect():
        assert r.ids == own.encode(r.text or "") and r.text_again == (r.text or "") and r.same
    assert pieces.encode(docs.where("false"), MODEL_PATH).count() == 0


def test_turns_come_back():
    template, draw = chat.Template(), random.Random(0)
    marks = ["a", "\\", *template.controls, " [/INST]", "[INST] ", " ", "[", "<", "é", "\n"]
    for _ in range(5000):
        text = "".join(draw.choice(marks) for _ in range(draw.randrange(8)))
        role = draw.choice(["user", "assistant", "system", "tool", "", "[ROLE]", "a\\"])
        rendered, start, end, level = chat.format_turn(template, role, text)
        assert chat.unescape(rendered[start:end]) == text
        other = chat.format_turn(template, "user", text)[0]
        assert list(chat.parse(template, rendered + other)) == [(role, text), ("user", text)]
        assert (level == 0) == (not template.conflict.search(text))
    for wrong in ("[INST] a", "a", "[INST] a</s> [/INST]", "<s>a\\"):
        with pytest.raises(chat.GrammarError):
            list(chat.parse(template, wrong))


def test_conversations_edge_cases(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"),
        (2, None, None, QUOTED), (2, 0, "assistant", LONG), (None, 0, "assistant", "x"),
    ]
    turns = with_clashes(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    )
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("user\n\nassistant\nb\nassistant\nb\n")
    assert got[1].loss_chars == 2 and got[1].loss_sha256 == sha("bb")
    assert got[2].turns_sha256 == sha(f"\n{QUOTED}\nassistant\n{LONG}\n") and got[2].escaped_turns == 1
    assert got[None].loss_chars == 1
    assert chat.read_back(chat.format_conversations(turns.where("false"))).count() == 0


def test_archives(spark, tmp_path):
    rows = [
        (1, None, None), (2, "u\r\nx", "a"), (3, None, "a"), (None, "q", "a"), (2, "z", "a"),
        (9, None, ""), (10, "h", LONG), (11, "h", "\r\n\r\nWARC/1.1\r\n\r\né"),
    ]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.archive_and_read(pages, str(tmp_path / "a")).collect()
    keeper = defaultdict(lambda: -1)
    for i, _, h in rows:
        keeper[h or ""] = max(keeper[h or ""], i if i is not None else -1)
    want = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        k = keeper[h or ""]
        want[i, len(body), digest, *(("response", None) if i == k else ("revisit", k))] += 1
    seen = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got
    )
    assert seen == want
    none = pages.where("false").select("page_id", "url", "html")
    assert warc.archive_and_read(none, str(tmp_path / "b")).count() == 0


def test_archives_lead_with_their_dictionary(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    warc.write_archive(pages.coalesce(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    data = file.read_bytes()
    assert data[:4] == warc.DICTIONARY_MAGIC
    n = int.from_bytes(data[4:8], "little")
    shared = zstandard.ZstdCompressionDict(data[8 : 8 + n])
    reader = zstandard.ZstdDecompressor(dict_data=shared)
    # Any reader of the format skips the separators.
    plain = reader.stream_reader(data[8 + n :], read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == pages.count()


def test_archives_of_pages_that_quote_separators(spark, tmp_path):
    """Frames that separate records, as far as a page can know them, in every page."""
    quoted = ["P*M\x18\0\0\0\0", "P*M\x18\x10\0\0\0", "]*M\x18\0\0\0\0", "(\xb5/\xfd"]
    rows = [(i, f"u{i}", f"{''.join(quoted)} page {i % 300} {quoted[i % 4]}" * 5) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r for r in warc.archive_and_read(pages, str(tmp_path / "q")).collect()}
    assert len(got) == 400
    for i, url, html in rows:
        keeper = i + 300 if i < 100 else i
        assert got[i].url == url and got[i].payload_bytes == len(html.encode())
        assert got[i].record_type == ("revisit" if i < 100 else "response")
        assert got[keeper].payload.decode() == html


@pytest.mark.parametrize("rows", [[(1, "u", "a")], [(1, "u", None)] * 3, [(5, "u", "x y " * 600_000), (6, "v", "b")]])
def test_small_archives_and_oversized_pages(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.archive_and_read(pages, str(tmp_path / "s")).collect()
    want = Counter((i, u, h or "") for i, u, h in rows)
    assert Counter((r.page_id, r.url, r.payload.decode()) for r in got) == want
    (file,) = (tmp_path / "s").glob("part-*")
    assert file.read_bytes()[:4] == warc.DICTIONARY_MAGIC


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 1000)
    monkeypatch.setattr(warc, "SAMPLE_PAGE_BYTES", 300)
    rows = [(i % 50, "u", "x" * (100 + 40 * (i % 9))) for i in range(900)] + [(7, "u", "y" * 200)] * 500
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.sample_records(pages, "page_id", "url", "html")
    payloads = [warc.parse_record(r)["payload_bytes"] for r in found]
    assert found and sum(payloads) <= 1000 and max(payloads) <= 300
    assert found == warc.sample_records(pages.repartition(3), "page_id", "url", "html")


def test_phrases_do_not_depend_on_the_offset():
    text = " ".join(words(400, 2))
    a, b = fingerprint.fingerprints([text])[0], fingerprint.fingerprints(["xx y" + text])[0]
    assert fingerprint.likeness(a, b) > 0.9
    other = fingerprint.fingerprints([" ".join(words(400, 3, size=10**6))])[0]
    assert fingerprint.likeness(a, other) < 0.2
    texts = [text, "", "a", "aaaaaaa", "ab" * 50, text, LONG, "é😀" * 9]
    together = fingerprint.fingerprints(texts)
    assert together == [fingerprint.fingerprints([t])[0] for t in texts]
    assert together[0] == together[5] and together[1] == "ffff" * fingerprint.SLOTS


def test_documents_beside_the_next(spark):
    rows = [(i, t) for i, t in edge_texts() if i is not None and i != 8] + [
        (100 + i, " ".join(words(40 + i, i))) for i in range(60)
    ]
    rows = list(dict(rows).items())
    docs = with_clashes(documents(spark, rows)).repartition(7)
    got = {r.doc_id: r for r in fingerprint.compare_with_next(docs).collect()}
    assert len(got) == len(rows)
    texts = [(i, t or "") for i, t in sorted(rows)]
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        e = fingerprint.edited(t, after)
        f, g, h = (fingerprint.fingerprints([x])[0] for x in (t, e, after))
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (f, g)
        assert got[i].near_edited == fingerprint.likeness(f, g)
        assert got[i].near_next == fingerprint.likeness(f, h)


def test_next_documents_with_nulls_repeats_and_one_row(spark):
    docs = documents(spark, edge_texts())
    assert fingerprint.compare_with_next(docs).count() == docs.count()
    one = fingerprint.compare_with_next(documents(spark, [(5, "abcdefgh")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint.compare_with_next(docs.where("false")).count() == 0


def test_query_results_have_one_row_each(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op5_pii", "op9_sentencepiece"):
        assert llm_queries()[name](spark, sf).count() == docs
    assert llm_queries()["op9_sentencepiece"](spark, sf).where(~(F.col("parity") & F.col("round_trip"))).isEmpty()
