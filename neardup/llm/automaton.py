"""Byte-level BPE by a tokenization automaton.

The merges of a vocabulary are compiled into one deterministic automaton whose
arcs bear tokens and which accepts exactly the token sequences that the merges
make. It starts as one state with an arc for each byte. Merges are then taken in
their order, and each puts in its gadget: for ``u v -> uv``

* the new arc ``uv`` leaves every state that has ``u`` and leads where ``u v`` led;
* the state behind ``u`` loses its arc ``v``.

A state is copied only when it starts to differ from those it was shared with,
and arcs that every state treats alike share a class, one bit in the state's row.

A word is encoded by going over its places: from the arc that reaches a place
follow, byte by byte, the arcs that its state has. Each place is reached by one arc
only, since the beginning of a word has one accepted sequence, and the arcs that
lead back from the end are its tokens. To decode, the labels of the arcs are emitted.

Words are split off by the pattern of byte-level vocabularies. Which characters are
letters, numbers and blanks depends on the version of Unicode, so the tokenizers
library is asked, once for each block of characters that a worker meets.

Defined results: a null or empty text has no tokens; null ids decode to the empty
text, unknown ids to nothing; repeated rows are alike; other columns pass through.
Texts are encoded whole, in steps of bounded length.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from dataclasses import dataclass
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import fresh_name, steps, text_or_empty

#: Characters of text worked on at once in a task.
ENCODE_CHARS = 1 << 18
#: Words whose tokens a worker remembers before it starts anew.
CACHED_WORDS = 1 << 18
#: Bytes of a word from which it is walked by itself: few others are as long.
LONG_WORD = 64
#: Words times bytes of the longest among words that are walked together.
WALK_BYTES = 1 << 18

# Fixed value of the format: the pattern of byte-level vocabularies, with the
# classes of letters, numbers and white space to be put in.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
LETTER, NUMBER, BLANK, OTHER = "LNSO"


def _byte_chars() -> list[str]:
    """The character that stands for each byte in such a vocabulary's file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


BYTE_OF = {c: b for b, c in enumerate(_byte_chars())}


@dataclass(frozen=True)
class Vocabulary:
    """What the file of a byte-level BPE says."""

    labels: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    added: dict[str, int]


def read_vocabulary(data: str) -> Vocabulary:
    """Parses the file of the tokenizers library; raises where it needs more than this module."""
    whole = json.loads(data)
    model = whole["model"]
    unlike = [k for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges") if model.get(k)]
    unlike += [k for k in ("continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    splits = whole.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or unlike or whole.get("normalizer"):
        raise ValueError(f"not a plain byte-level BPE: {unlike or whole.get('normalizer')}")
    if splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") or not splits.get("use_regex", True):
        raise ValueError("texts must be split by the byte-level pattern, without a leading space")
    if (whole.get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError("the decoder must join bytes")
    vocab = model["vocab"]
    labels = {i: bytes(BYTE_OF[c] for c in token) for token, i in vocab.items()}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    added = {}
    for token in whole.get("added_tokens", ()):
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token with conditions: {token['content']}")
        content = token["content"]
        added[content] = token["id"]
        known = all(c in BYTE_OF for c in content)
        labels[token["id"]] = bytes(map(BYTE_OF.get, content)) if known else content.encode()
    return Vocabulary(labels, merges, added)


@dataclass(frozen=True)
class Automaton:
    """Rows of bits by state: which classes of arcs leave it. State 0 is the start."""

    rows: np.ndarray
    state_of: np.ndarray  # by token, the state that its arc leads to
    class_of: np.ndarray  # by token, the class of its arc; -1 where no merge makes it

    def accepts(self, tokens: list[int]) -> bool:
        state = 0
        for t in tokens:
            c = self.class_of[t]
            if c < 0 or not self.rows[state, c >> 3] >> (c & 7) & 1:
                return False
            state = self.state_of[t]
        return True


def compile_merges(vocabulary: Vocabulary) -> Automaton:
    """The automaton after the gadgets of all merges, in their order."""
    merges = vocabulary.merges
    size = max(vocabulary.labels) + 1
    rows = np.zeros((1024, 128), dtype=np.uint8)
    state_of = np.full(size, -1, dtype=np.int32)
    class_of = np.full(size, -1, dtype=np.int32)
    bytes_alone = [i for i, label in vocabulary.labels.items() if len(label) == 1]
    if len({vocabulary.labels[i] for i in bytes_alone}) != 256 or len(bytes_alone) != 256:
        raise ValueError("every byte needs one token of its own")
    # The start and all bytes share state 0 at first, all bytes one class of arcs.
    rows[0, 0] = 1
    state_of[bytes_alone] = class_of[bytes_alone] = 0
    shared_state, shared_class = Counter({0: 257}), Counter({0: 256})
    for u, v, uv in merges:
        if class_of[u] < 0 or class_of[v] < 0:
            raise ValueError("a merge comes before the merges that make its parts")
        if class_of[uv] >= 0:
            raise ValueError("two merges make one token")
        c = class_of[v]
        if not rows[state_of[u], c >> 3] >> (c & 7) & 1:
            continue  # earlier merges never leave these two side by side
        state_of[uv] = state_of[v]
        shared_state[state_of[v]] += 1
        if shared_state[s := state_of[u]] > 1:
            new = len(shared_state)
            if new == len(rows):
                rows = np.concatenate([rows, np.zeros_like(rows)])
            rows[new] = rows[s]
            shared_state[s] -= 1
            shared_state[new] = 1
            state_of[u] = new
        if shared_class[c] > 1:
            new = len(shared_class)
            if new >> 3 == rows.shape[1]:
                rows = np.concatenate([rows, np.zeros_like(rows)], axis=1)
            open_to = (rows[:, c >> 3] >> (c & 7) & 1).astype(np.uint8)
            rows[:, new >> 3] |= open_to << np.uint8(new & 7)
            shared_class[c] -= 1
            shared_class[new] = 1
            class_of[v] = c = new
        rows[state_of[u], c >> 3] &= 255 - (1 << (c & 7))
        # After the arc is gone: behind u itself, uv must not follow either if u is v.
        class_of[uv] = class_of[u]
        shared_class[class_of[u]] += 1
    used = rows[: len(shared_state), : (len(shared_class) + 7) // 8]
    return Automaton(np.ascontiguousarray(used), state_of, class_of)


class Coder:
    """Encodes in one worker; remembers the tokens of words, as int32 bytes."""

    def __init__(self, labels: dict[int, bytes], added: dict[str, int], automaton: Automaton):
        self.automaton = automaton
        self.added = {c: np.int32(t).tobytes() for c, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        # Arcs spelled byte by byte: (place in the table << 8 | byte) -> next place.
        arcs = np.flatnonzero(automaton.class_of >= 0).tolist()
        self.step = step = {}
        at_end = {}
        for t in arcs:
            place = 0
            for b in labels[t]:
                place = step.setdefault(place << 8 | b, len(step) + 1)
            at_end[place] = t
        # A place that arcs go on from has a row of the table; 0, the start, follows no place.
        self.arc_at = np.full(len(step) + 1, -1, dtype=np.int32)
        self.arc_at[list(at_end)] = list(at_end.values())
        keys = np.fromiter(step, dtype=np.int64, count=len(step))
        inner, row = np.unique(keys >> 8, return_inverse=True)
        self.row_of = np.full(len(step) + 1, len(inner), dtype=np.int32)
        self.row_of[inner] = np.arange(len(inner))
        self.table = np.zeros((len(inner) + 1, 256), dtype=np.int32)
        self.table[row, keys & 255] = np.fromiter(step.values(), dtype=np.int32, count=len(step))
        self.length_of = np.zeros(len(automaton.class_of), dtype=np.int64)
        self.length_of[arcs] = [len(labels[t]) for t in arcs]
        self.known: dict[str, bytes] = {}
        self.blocks: dict[int, list[str]] = {}
        self.pattern = self.ascii = None
        self._learn_blocks({0})
        self.ascii = self.pattern

    def walk_one(self, word: bytes) -> bytes:
        """The ids on the one accepted way that spells ``word``."""
        rows, state_of, class_of = (
            self.automaton.rows,
            self.automaton.state_of,
            self.automaton.class_of,
        )
        n = len(word)
        reached = np.full(n + 1, -1, dtype=np.int32)
        for i in range(n):
            row, place = rows[state_of[reached[i]] if i else 0], 0
            for j in range(i, n):
                place = self.step.get(place << 8 | word[j])
                if place is None:
                    break
                arc = self.arc_at[place]
                if arc >= 0 and row[class_of[arc] >> 3] >> (class_of[arc] & 7) & 1:
                    reached[j + 1] = arc
        back, i = [], n
        while i:
            back.append(reached[i])
            i -= self.length_of[reached[i]]
        return np.array(back[::-1], dtype=np.int32).tobytes()

    def walk(self, words: list[bytes]) -> list[bytes]:
        """:meth:`walk_one` of many words, which take each step together."""
        rows, state_of, class_of = (
            self.automaton.rows,
            self.automaton.state_of,
            self.automaton.class_of,
        )
        lengths = np.array(list(map(len, words)))
        n, longest = len(words), int(lengths.max(initial=0))
        data = np.frombuffer(b"".join([w.ljust(longest, b"\0") for w in words]), dtype=np.uint8)
        data = data.reshape(n, longest)
        reached = np.full((n, longest + 1), -1, dtype=np.int32)
        for i in range(longest):
            at = np.flatnonzero(lengths > i)
            state = state_of[reached[at, i]] if i else np.zeros(len(at), dtype=np.int32)
            place = np.zeros(len(at), dtype=np.int32)
            for j in range(i, longest):
                place = self.table[self.row_of[place], data[at, j]]
                on = (place > 0) & (lengths[at] > j)
                at, state, place = at[on], state[on], place[on]
                if not len(at):
                    break
                arc = self.arc_at[place]
                c = class_of[arc]
                ok = (arc >= 0) & (rows[state, c >> 3] >> (c & 7) & 1).astype(bool)
                reached[at[ok], j + 1] = arc[ok]
        # Back from the ends, into the right part of a row each.
        ids = np.zeros((n, longest), dtype=np.int32)
        counts, at, place = np.zeros(n, dtype=np.int64), np.flatnonzero(lengths), lengths.copy()
        while len(at):
            arc = reached[at, place[at]]
            counts[at] += 1
            ids[at, longest - counts[at]] = arc
            place[at] -= self.length_of[arc]
            at = at[place[at] > 0]
        flat = ids[np.arange(longest) >= (longest - counts)[:, None]].tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: set[str]) -> None:
        """Adds words, shortest first; words of about one length share a table of bounded size."""
        written = list(words)
        spelled = [w.encode() for w in written]
        lengths = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
        order = np.argsort(lengths).tolist()
        while order and lengths[order[-1]] > LONG_WORD:
            i = order.pop()
            self.known[written[i]] = self.walk_one(spelled[i])
        start = 0
        for end in range(1, len(order) + 1):
            if end == len(order) or (end - start + 1) * lengths[order[end]] > WALK_BYTES:
                some = order[start:end]
                found = self.walk([spelled[i] for i in some])
                self.known.update(zip([written[i] for i in some], found))
                start = end

    def _learn_blocks(self, blocks: set[int]) -> None:
        """Asks the library how it sorts the 256 characters of each block; a new pattern."""
        from tokenizers import pre_tokenizers

        split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

        def kind(c: str) -> str:
            if len(split(f"a{c}")) == 1:
                return LETTER
            if len(split(f"1{c}")) == 1:
                return NUMBER
            return OTHER if len(split(f"!{c}!")) == 1 else BLANK

        for block in blocks:
            self.blocks[block] = [kind(chr(c)) for c in range(block << 8, (block + 1) << 8)]
        runs: dict[str, str] = {LETTER: "", NUMBER: "", BLANK: ""}
        chars = ((b << 8 | i, k) for b in sorted(self.blocks) for i, k in enumerate(self.blocks[b]))
        # Characters in a row of one kind make one range.
        for (k, _), run in groupby(chars, key=lambda x, n=count(): (x[1], x[0] - next(n))):
            if k != OTHER:
                run = [c for c, _ in run]
                runs[k] += f"\\U{run[0]:08x}-\\U{run[-1]:08x}"
        self.pattern = re.compile(PATTERN.format(**runs))

    def words_of(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        new = {ord(c) >> 8 for c in set(text)}.difference(self.blocks)
        if new:
            self._learn_blocks(new)
        return self.pattern.findall(text)

    def _split(self, text: str) -> list[str]:
        """Words and added tokens; no word is written like an added token, which goes before."""
        if not any(map(text.__contains__, self.added)):
            return self.words_of(text)
        parts = self.added_split.split(text)
        words = [[p] if i % 2 else self.words_of(p) for i, p in enumerate(parts)]
        return [w for part in words for w in part]

    def encode(self, texts: list[str]) -> list[bytes]:
        """int32 ids of each text, as bytes."""
        split = [self._split(t) for t in texts]
        words = set().union(*split)
        new = words.difference(self.known, self.added)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = {}
            new = words.difference(self.added)
        self.learn(new)
        self.known.update(self.added)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


class Labels:
    """Decodes in one worker: the labels of arcs one after another."""

    def __init__(self, labels: dict[int, bytes]):
        self.unknown = max(labels) + 1
        every = [labels.get(i, b"") for i in range(self.unknown + 1)]
        self.labels = pa.array(every, pa.binary())

    def decode(self, rows: pa.ListArray) -> pa.Array:
        """Texts; bytes that are no text become U+FFFD, as in the library."""
        ids = rows.flatten().to_numpy(zero_copy_only=False)
        ids = np.where((ids < 0) | (ids > self.unknown), self.unknown, ids)
        offsets = pc.subtract(rows.offsets, rows.offsets[0])
        emitted = pa.ListArray.from_arrays(offsets, self.labels.take(pa.array(ids)))
        joined = pc.binary_join(emitted, b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            texts = [x.decode("utf-8", "replace") for x in joined.to_pylist()]
            return pa.array(texts, pa.string())


_workers: dict[str, tuple] = {}


def _of_worker(kind: type, shared, name: str):
    """The ``kind`` of this Python worker, made from the shared values once."""
    if _workers.get(kind.__name__, ("",))[0] != name:
        _workers[kind.__name__] = name, kind(*shared.value)
    return _workers[kind.__name__][1]


class Tokenizer:
    """A vocabulary compiled once on the driver, for any DataFrame.

    Workers get the automaton and the labels, both of the order of the vocabulary's file.
    """

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            vocabulary = read_vocabulary(f.read())
        labels, added = vocabulary.labels, vocabulary.added
        self.name = uuid.uuid4().hex
        self.coder = spark.sparkContext.broadcast((labels, added, compile_merges(vocabulary)))
        self.labels = spark.sparkContext.broadcast((labels,))

    def encode(
        self,
        docs: DataFrame,
        text_col: str = "text",
        output_col: str = "tokens",
        decoded_col: str | None = None,
    ) -> DataFrame:
        """Adds the token ids of each text; ``decoded_col`` gets what they spell, in the same step."""
        name, shared, spells = self.name, self.coder, self.labels

        @F.arrow_udf("struct<ids:array<int>,back:string>")
        def run(texts: pa.Array) -> pa.Array:
            coder = _of_worker(Coder, shared, name)
            ids, back = [pa.array([], pa.list_(pa.int32()))], [pa.array([], pa.string())]
            for a, b in steps(pc.utf8_length(texts).to_pylist(), ENCODE_CHARS):
                found = coder.encode(texts.slice(a, b - a).to_pylist())
                ends = np.cumsum([0, *map(len, found)]) // 4
                flat = np.frombuffer(b"".join(found), dtype=np.int32)
                ids.append(pa.ListArray.from_arrays(ends.astype(np.int32), flat))
                if decoded_col is not None:
                    back.append(_of_worker(Labels, spells, name).decode(ids[-1]))
                else:
                    back.append(pa.nulls(b - a, pa.string()))
            parts = [pa.concat_arrays(ids), pa.concat_arrays(back)]
            return pa.StructArray.from_arrays(parts, ["ids", "back"])

        found = fresh_name(docs, "_found")
        both = docs.withColumn(found, run.asNondeterministic()(text_or_empty(text_col)))
        out = both.withColumn(output_col, F.col(f"{found}.ids"))
        if decoded_col is not None:
            out = out.withColumn(decoded_col, F.col(f"{found}.back"))
        return out.drop(found)

    def decode(self, docs: DataFrame, tokens_col: str = "tokens", output_col: str = "decoded") -> DataFrame:
        """Adds the text that token ids spell."""
        name, spells = self.name, self.labels

        @F.arrow_udf("string")
        def run(tokens: pa.Array) -> pa.Array:
            labels, out = _of_worker(Labels, spells, name), [pa.array([], pa.string())]
            for a, b in steps(tokens.value_lengths().to_pylist(), ENCODE_CHARS):
                out.append(labels.decode(tokens.slice(a, b - a)))
            return pa.concat_arrays(out)

        column = F.coalesce(F.col(tokens_col), F.array().cast("array<int>"))
        return docs.withColumn(output_col, run.asNondeterministic()(column))
