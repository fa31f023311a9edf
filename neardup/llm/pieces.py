"""SentencePiece models run by the tokenizers library.

The model file is a protocol buffer; its wire format is read here directly, so
that neither a generated schema nor the original library is needed to encode.
The normaliser, the metaspace marker, the scores (unigram models) or merges
(BPE models) and byte fallback are rebuilt from it.

Defined results: a null or empty text has no pieces and decodes to the empty
text; repeated rows get equal pieces; other columns of the input pass through.
Text is encoded in steps of bounded length, of whole texts; a text is never cut.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import fresh_name, return_memory, steps, text_or_empty

META = "▁"
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Characters of text encoded at once in a task.
ENCODE_CHARS = 1 << 18
#: Words whose ids a worker remembers before it starts anew.
CACHED_WORDS = 1 << 16
#: New words that are encoded as one string.
WORDS_AT_ONCE = 64


@dataclass
class PieceModel:
    """What a model file says: pieces as (text, score, kind) and its settings."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown_id(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            if at >= len(data):
                raise ValueError("not a model file: it ends inside a number")
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if size is None:
            if wire != 2:
                raise ValueError(f"not a model file: wire type {wire}")
            size = varint()
        if at + size > len(data):
            raise ValueError("not a model file: it ends inside a field")
        yield number, data[at : at + size]
        at += size


def parse_model(data: bytes) -> PieceModel:
    """Reads the serialized model."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:  # a piece
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            model.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:  # how it was trained
            settings = dict(_fields(value))
            model.kind = settings.get(3, UNIGRAM)
            model.byte_fallback = bool(settings.get(35, 0))
        elif number == 3:  # normaliser
            settings = dict(_fields(value))
            model.charsmap = settings.get(2, b"")
            model.dummy_prefix = bool(settings.get(3, 1))
            model.squeeze_spaces = bool(settings.get(4, 1))
            model.escape_spaces = bool(settings.get(5, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"models of kind {model.kind} are not supported")
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces that make up another piece, best score first."""
    known = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    pairs = []
    for i, (piece, score, kind) in enumerate(model.pieces):
        if kind == NORMAL:
            cuts = ((piece[:k], piece[k:]) for k in range(1, len(piece)))
            pairs += [(-score, i, a, b) for a, b in cuts if a in known and b in known]
    return [(a, b) for _, _, a, b in sorted(pairs, key=lambda x: x[:2])]


def build_tokenizer(data: bytes):
    """A ``tokenizers.Tokenizer`` that encodes and decodes as the model does."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    model = parse_model(data)
    if model.kind == UNIGRAM:
        scored = [(p, s) for p, s, _ in model.pieces]
        core = models.Unigram(scored, model.unknown_id, model.byte_fallback)
    else:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges=_merges(model),
            unk_token=model.pieces[model.unknown_id][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    normal = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        normal += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    space = META if model.escape_spaces else " "
    if model.dummy_prefix:
        normal.append(normalizers.Prepend(space))
    if model.escape_spaces:
        normal.append(normalizers.Replace(" ", META))
    tokenizer.normalizer = normalizers.Sequence(normal)
    back = [decoders.Replace(META, " ")] if model.escape_spaces else []
    back += [decoders.ByteFallback()] if model.byte_fallback else []
    back += [decoders.Fuse()]
    back += [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence(back)
    own = [AddedToken(p, normalized=False) for p, _, k in model.pieces if k == USER_DEFINED]
    if own:
        tokenizer.add_tokens(own)
    return tokenizer


def splits_at_words(model: PieceModel) -> bool:
    """Whether no piece reaches from one word into the next.

    Holds for BPE models whose marker occurs at the start of pieces only: then
    no merge crosses the start of a word, and a text's ids are those of its words.
    """
    plain = all(META not in p.lstrip(META) for p, _, _ in model.pieces)
    return (
        model.kind == BPE
        and model.escape_spaces
        and model.dummy_prefix
        and plain
        and all(kind != USER_DEFINED for _, _, kind in model.pieces)
    )


class _Words:
    """Ids of the words seen by a worker, as one array with offsets.

    A key is a normalised word without its first marker. With ``own``, the
    sentencepiece library's processor, each new word is also encoded by it.
    """

    def __init__(self, tokenizer, own=None):
        from tokenizers import Tokenizer, pre_tokenizers

        self.core = Tokenizer(tokenizer.model)  # words come normalised
        self.core.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="never")
        self.one_word = Tokenizer(tokenizer.model)
        self.own = own
        pieces = sorted(tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.opens = np.array([p.startswith(META) for p, _ in pieces])
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.same = np.ones(1 << 14, dtype=bool)

    def _store(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray, same) -> None:
        first, n = len(self.number), len(keys)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + n + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.same = np.concatenate([self.same, np.ones_like(self.same)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[first + 1 : first + n + 1] = self.used + np.cumsum(sizes)
        self.same[first : first + n] = same
        self.used += len(ids)
        self.number.update(zip(keys, range(first, first + n)))

    def learn(self, keys: set[str]) -> None:
        """Encode new words: many in one string, whose pieces tell where a word starts."""
        simple = [k for k in keys if k and META not in k]
        parts = [simple[i : i + WORDS_AT_ONCE] for i in range(0, len(simple), WORDS_AT_ONCE)]
        found = self.core.encode_batch_fast(
            ["".join(META + k for k in part) for part in parts], add_special_tokens=False
        )
        checked = None
        if self.own is not None:
            checked = self.own.encode([" ".join(part) for part in parts], num_threads=1)
        for i, (part, got) in enumerate(zip(parts, found)):
            ids = np.array(got.ids, dtype=np.int32)
            starts = np.flatnonzero(self.opens[ids])
            sizes = np.diff(starts, append=len(ids))
            same = checked is None or np.array_equal(ids, checked[i])
            if len(sizes) != len(part):
                raise ValueError("words and pieces do not agree")
            self._store(part, ids, sizes, same)
        for key in keys.difference(simple):  # runs of spaces
            found = self.one_word.encode(META + key, add_special_tokens=False)
            ids = np.array(found.ids, np.int32)
            same = self.own is None or np.array_equal(ids, self._own_run(META + key))
            self._store([key], ids, np.array([len(ids)]), same)

    def _own_run(self, word: str) -> list[int]:
        # After a letter, as the library would not encode a lone space at the start.
        return self.own.encode("a" + word.replace(META, " "))[len(self.own.encode("a")) :]

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ids per word and agreement per word, in the order of ``words``."""
        new = set(words).difference(self.number)
        if len(self.number) + len(new) > CACHED_WORDS:
            self.clear()
            new = set(words)
        if new:
            self.learn(new)
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        first, sizes = self.start[at], self.start[at + 1] - self.start[at]
        ends = np.cumsum(sizes)
        shift = np.repeat(first - (ends - sizes), sizes)
        return self.flat[np.arange(len(shift)) + shift], sizes, self.same[at]


class Encoder:
    """Encodes and decodes with the tokenizers library, ``threads`` at once.

    With ``parity`` the sentencepiece library encodes the same strings: every
    distinct word where texts split at words, else whole texts.
    """

    def __init__(self, data: bytes, threads: int = 1, parity: bool = False):
        # Threads of the library within this worker; tasks are Spark's.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.tokenizer = build_tokenizer(data)
        self.model = model = parse_model(data)
        self.own = None
        if parity:
            import sentencepiece

            self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.words = _Words(self.tokenizer, self.own) if splits_at_words(model) else None
        self.plain = pa.array([_plain(p, k, model) for p, _, k in model.pieces], pa.string())

    @classmethod
    def of(cls, *settings) -> Encoder:
        """The one of this Python worker."""
        if settings not in _built:
            _built[settings] = cls(*settings)
        return _built[settings]

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        """Ids of the texts and whether both libraries agree. Callers bound the texts."""
        return self._by_words(texts) if self.words is not None else self._whole(texts)

    def _whole(self, texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids if t else [] for e, t in zip(found, texts)]
        same = np.ones(len(texts), dtype=bool)
        if self.own is not None:
            same = np.array([w == g for w, g in zip(self.own.encode(texts), ids)], dtype=bool)
        return pa.array(ids, pa.list_(pa.int32())), same

    def _by_words(self, texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        model = self.model
        if model.charsmap or model.squeeze_spaces:
            texts = [self.tokenizer.normalizer.normalize_str(t) if t else "" for t in texts]
        else:
            lead = META if model.dummy_prefix else ""
            texts = [lead + t.replace(" ", META) if t else "" for t in texts]
        if any(t and t[0] != META for t in texts):
            raise ValueError("a model without the first marker cannot be split at words")
        split = [_words_of(t) for t in texts]
        counts = np.array([len(words) for words in split])
        ids, sizes, same = self.words.lookup(list(chain.from_iterable(split)))
        of_text = np.repeat(np.arange(len(texts)), counts)
        per_text = np.bincount(of_text, weights=sizes, minlength=len(texts)).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
        wrong = np.bincount(of_text, weights=~same, minlength=len(texts)) > 0
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), ~wrong

    def decode(self, rows: pa.ListArray) -> pa.Array:
        """Texts of the ids; those with byte pieces are joined by the library."""
        pieces = pa.ListArray.from_arrays(
            pc.subtract(rows.offsets, rows.offsets[0]), self.plain.take(rows.flatten())
        )
        out = pc.binary_join(pieces, "")
        if self.model.dummy_prefix:
            out = pc.if_else(pc.starts_with(out, " "), pc.utf8_slice_codeunits(out, 1), out)
        hard = pc.is_null(out)
        if pc.any(hard).as_py():
            ids = rows.filter(hard).to_pylist()
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            out = pc.replace_with_mask(out, hard, pa.array(back, pa.string()))
        return out


_built: dict[tuple, Encoder] = {}


def _plain(piece: str, kind: int, model: PieceModel) -> str | None:
    """A piece as it appears in text; None where the library has to join bytes."""
    if kind == BYTE:
        byte = int(piece[1:-1], 16)
        return chr(byte) if byte < 128 else None
    return piece.replace(META, " ") if model.escape_spaces else piece


def _words_of(text: str) -> list[str]:
    """Words of a normalised text, each without its first marker."""
    if META * 2 not in text:
        return text.split(META)[1:]
    return [w[1:] for w in _RUN.findall(text)]


_RUN = re.compile(f"{META}+[^{META}]*")


def _settings(df: DataFrame, model_path: str, threads: int | None, parity: bool = False):
    """The model's bytes and settings, for every worker."""
    with open(model_path, "rb") as f:
        data = f.read()
    parse_model(data)  # a wrong file fails here
    sc = df.sparkSession.sparkContext
    return sc.broadcast((data, threads or int(sc.getConf().get("spark.task.cpus", "1")), parity))


def encode(
    docs: DataFrame,
    model_path: str,
    text_col: str = "text",
    output_col: str = "pieces",
    parity_col: str | None = None,
    round_trip_col: str | None = None,
    threads: int | None = None,
) -> DataFrame:
    """Adds the piece ids of each text.

    ``parity_col`` gets whether both libraries agree, ``round_trip_col`` whether
    the ids decode to the text again. ``threads`` per task: spark.task.cpus if
    not given.
    """
    settings = _settings(docs, model_path, threads, parity_col is not None)

    @F.arrow_udf("struct<pieces:array<int>,same:boolean,back:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder.of(*settings.value)
        for texts in batches:
            ids, same = [pa.array([], pa.list_(pa.int32()))], [np.zeros(0, dtype=bool)]
            back = [pa.array([], pa.bool_())]
            for a, b in steps(pc.utf8_length(texts).to_pylist(), ENCODE_CHARS):
                part = texts.slice(a, b - a)
                some, agree = encoder.encode(part.to_pylist())
                ids.append(some)
                same.append(agree)
                if round_trip_col is not None:
                    back.append(pc.equal(encoder.decode(some), part))
                else:
                    back.append(pa.nulls(len(part), pa.bool_()))
            parts = [pa.concat_arrays(ids), pa.array(np.concatenate(same)), pa.concat_arrays(back)]
            del ids, same, back
            yield pa.StructArray.from_arrays(parts, ["pieces", "same", "back"])
            return_memory()

    found = fresh_name(docs, "_found")
    # Else a filter on the result would encode a second time.
    both = docs.withColumn(found, run.asNondeterministic()(text_or_empty(text_col)))
    out = both.withColumn(output_col, F.col(f"{found}.pieces"))
    if parity_col is not None:
        out = out.withColumn(parity_col, F.col(f"{found}.same"))
    if round_trip_col is not None:
        out = out.withColumn(round_trip_col, F.col(f"{found}.back"))
    return out.drop(found)


def decode(
    docs: DataFrame,
    model_path: str,
    pieces_col: str = "pieces",
    output_col: str = "decoded",
    threads: int | None = None,
) -> DataFrame:
    """Adds the text of piece ids; null ids decode to the empty text."""
    settings = _settings(docs, model_path, threads)

    @F.arrow_udf("string")
    def run(pieces: pa.Array) -> pa.Array:
        encoder, out = Encoder.of(*settings.value), [pa.array([], pa.string())]
        for a, b in steps(pieces.value_lengths().to_pylist(), ENCODE_CHARS):
            out.append(encoder.decode(pieces.slice(a, b - a)))
        return pa.concat_arrays(out)

    column = F.coalesce(F.col(pieces_col), F.array().cast("array<int>"))
    return docs.withColumn(output_col, run.asNondeterministic()(column))
