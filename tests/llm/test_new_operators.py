"""Importance resampling, the tokenization automaton and the filter audit."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from neardup.llm import audit, automaton, importance
from neardup.llm.queries import VOCABULARY_PATH, op11_importance, op12_automaton
from tests.llm.fixtures import LONG, documents, edge_texts, with_clashes, words

SF = "/root/testdata/sf0.001"


# --- importance ----------------------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    ws = WORD.findall(lower)
    runs = [b" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]
    return len(ws), [crc32(r) % 10000 for r in runs]


def brute_importance(docs, target):
    """{row: (n_features, weight, score, rank)} for rows (doc_id, text)."""
    found = [features(t) for _, t in docs]
    s = Counter(b for _, bs in found for b in bs)
    t = Counter(b for x in target for b in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
        for b in range(10000)
    ]
    out, able = [], []
    for i, ((doc_id, _), (n_words, bs)) in enumerate(zip(docs, found)):
        key = f"42:{'' if doc_id is None else doc_id}".encode()
        h = int(hashlib.sha256(key).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([len(bs), weight, score, None])
        if n_words >= 20:
            able.append((-score, doc_id is None, doc_id or 0, i))
    for rank, (*_, i) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        out[i][3] = rank
    return [tuple(x) for x in out]


def test_importance_of_the_whole_tables_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {d[0]: x for d, x in zip(docs, brute_importance(docs, target))}
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in op11_importance(spark, SF).collect()}
    assert got == want
    able = sum(features(t)[0] >= 20 for _, t in docs)
    assert sorted(x[3] for x in want.values() if x[3]) == list(range(1, 5 * able // 100 + 1))


def test_importance_of_awkward_rows(spark):
    rows = [*edge_texts(), (40, "A" * 50 + "-é-É-" + "z9" * 30), (41, "one, two; THREE ÀB4\x7fc " * 300)]
    rows += [(100 + i, " ".join(words(30, i))) for i in range(200)]
    rows += [(500, " ".join(words(30, 7)))] * 3
    docs = with_clashes(documents(spark, rows)).withColumn("importance", F.lit("x"))
    target = spark.createDataFrame([(" ".join(words(50, 1)),), (None,), ("",)], "text string")
    wanted = brute_importance(rows, [" ".join(words(50, 1)), None, ""])
    got = importance.importance(docs, target).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(
        (i, *x[:3]) for (i, _), x in zip(rows, wanted)
    )
    # Repeats of a row share its ranks among them.
    assert sorted((r["rank"], r.doc_id) for r in got if r["rank"]) == sorted(
        (x[3], i) for (i, _), x in zip(rows, wanted) if x[3]
    )
    drawn = importance.resample(docs, target)
    assert drawn.columns == docs.columns
    best = {i for (i, _), x in zip(rows, wanted) if x[3]}
    assert {r.doc_id for r in drawn.collect()} == best


def test_importance_of_empty_tables(spark):
    none = documents(spark, [])
    some = documents(spark, [(1, " ".join(words(60, 1)))] * 25)
    assert importance.importance(none, some).count() == 0
    assert importance.resample(none, some).count() == 0
    assert [r["rank"] for r in importance.importance(some, none).orderBy("rank").collect()][-1] == 1


def test_parts_of_a_text_change_nothing(monkeypatch):
    texts = [LONG[:5000], "", " ", "a", "a b", "ab " * 40, "x" * 300, "é" * 90 + " b " + "c" * 90]
    whole = [Counter(h for _, hs in importance.run_hashes(t.encode(), 3) for h in hs) for t in texts]
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(importance, "PART_BYTES", size)
        cut = [Counter(h for _, hs in importance.run_hashes(t.encode(), 3) for h in hs) for t in texts]
        assert cut == whole
    assert sum(whole[0].values()) == len(features(texts[0])[1])


# --- automaton -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY_PATH)


@pytest.fixture(scope="module")
def compiled():
    with open(VOCABULARY_PATH, encoding="utf-8") as f:
        vocabulary = automaton.read_vocabulary(f.read())
    return vocabulary.labels, vocabulary.added, automaton.compile_merges(vocabulary)


def odd_texts():
    draw = random.Random(5)
    some = ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "it's I'LL we'd ''s"]
    some += ["   a  b\n\n\tc \r\n \x1c\x1d\x85\xa0 x　 y​z", "½²Ⅷ٣ 漢字かな 😀😀", "aaaaaaa" * 9, "=-" * 99]
    some += ["漢" * 700, "x" * 5000, " " * 300, "\U000105c0Ᲊ\U00010d40 é �"]
    for _ in range(400):
        some.append("".join(draw.choice("abAB 01.'\n é漢") for _ in range(40)))
        some.append("".join(chr(draw.choice((draw.randrange(32, 0xD7FF), draw.randrange(0xE000, 0x1FFFF)))) for _ in range(20)))
    return some


def test_tokens_equal_the_library(spark, library):
    rows = [*edge_texts(), *enumerate(odd_texts(), 100)]
    docs = with_clashes(documents(spark, rows)).withColumn("decoded", F.lit(3))
    tokenizer = automaton.Tokenizer(spark, VOCABULARY_PATH)
    coded = tokenizer.decode(tokenizer.encode(docs, output_col="ids"), "ids", "back").collect()
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids
    assert Counter((r.doc_id, r.text, tuple(r.ids), r.back) for r in coded) == Counter(
        (i, t, tuple(ids(t)), library.decode(ids(t), skip_special_tokens=False)) for i, t in rows
    )
    assert tokenizer.encode(documents(spark, [])).count() == 0
    null = spark.createDataFrame([(None,), ([1, 5, 50256, 777777],)], "tokens array<int>")
    assert [r.decoded for r in tokenizer.decode(null).collect()] == ["", '"&<|endoftext|>']


def test_token_query_equals_the_library(spark, library):
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = set()
    for r in texts:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(back)))
    assert {tuple(r) for r in op12_automaton(spark, SF).collect()} == want


def test_random_ids_decode_like_the_library(compiled, library):
    labels, draw = automaton.Labels(compiled[0]), random.Random(3)
    ids = [[draw.randrange(50257) for _ in range(20)] for _ in range(500)]
    for rows in (ids, ids[:0], [[]]):
        found = labels.decode(pa.array(rows, pa.list_(pa.int32())))
        assert found.to_pylist() == library.decode_batch(rows, skip_special_tokens=False)


def test_ways_of_walking_agree(compiled):
    coder = automaton.Coder(*compiled)
    some = sorted({w for t in odd_texts() for w in t.split()} - {""})
    spelled = [w.encode() for w in some]
    assert coder.walk(spelled) == [coder.walk_one(w) for w in spelled]


def merged(word, merges):
    parts = list(word)
    for u, v in merges:
        i = 0
        while i < len(parts) - 1:
            if (parts[i], parts[i + 1]) == (u, v):
                parts[i : i + 2] = [u + v]
            i += 1
    return parts


@pytest.mark.parametrize("seed", range(6))
def test_automaton_accepts_what_merges_make_and_nothing_else(seed):
    """Over two letters, every token sequence of every short word."""
    draw = random.Random(seed)
    tokens, merges = ["a", "b"], []
    while len(merges) < 6:
        u, v = draw.choice(tokens), draw.choice(tokens)
        made = {w: merged(w, merges) for w in ("".join(x) for n in range(1, 9) for x in _words(n))}
        apart = any(p == (u, v) for m in made.values() for p in zip(m, m[1:]))
        if u + v not in tokens and apart:
            tokens.append(u + v)
            merges.append((u, v))
    ids = {t: i for i, t in enumerate(map(chr, range(256)))}
    ids |= {t: 256 + i for i, t in enumerate(t for t in tokens if len(t) > 1)}
    labels = {i: t.encode("latin-1") for t, i in ids.items()}
    vocabulary = automaton.Vocabulary(labels, [(ids[u], ids[v], ids[u + v]) for u, v in merges], {})
    found = automaton.compile_merges(vocabulary)
    coder = automaton.Coder(labels, {}, found)
    for n in range(1, 9):
        for word in map("".join, _words(n)):
            want = [ids[t] for t in merged(word, merges)]
            accepted = [s for s in _spellings(word, tokens) if found.accepts([ids[t] for t in s])]
            assert [[ids[t] for t in s] for s in accepted] == [want]
            assert coder.walk_one(word.encode()) == b"".join(i.to_bytes(4, "little") for i in want)


def _words(n):
    return ([c] + rest for c in "ab" for rest in _words(n - 1)) if n else iter([[]])


def _spellings(word, tokens):
    if not word:
        return [[]]
    return [[t, *s] for t in tokens if word.startswith(t) for s in _spellings(word[len(t) :], tokens)]


def test_files_that_need_more_are_refused():
    import json

    with open(VOCABULARY_PATH, encoding="utf-8") as f:
        whole = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"decoder": None}, {"pre_tokenizer": None}):
        with pytest.raises(ValueError):
            automaton.read_vocabulary(json.dumps(whole | change))
    backwards = whole | {"model": whole["model"] | {"merges": whole["model"]["merges"][::-1]}}
    with pytest.raises(ValueError):
        automaton.compile_merges(automaton.read_vocabulary(json.dumps(backwards)))


# --- audit ---------------------------------------------------------------------------


def failures_of(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        ("A" if len(ws) < 200 else "")
        + ("B" if 100 * len(set(ws)) < 50 * len(ws) else "")
        + ("C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else "")
        + ("D" if any(c in "#$%&*|" for c in text) else "")
    )


def brute_audit(docs, labels):
    """Rows (part, order, step, kept, removed, redundant, unique, good, toxic, shapley)."""
    rows = []
    for doc_id, text, part in docs:
        text = text or ""
        copied = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in docs
        )
        good = any(i == doc_id and q == 1 for i, q, _ in labels)
        toxic = any(i == doc_id and x == 1 for i, _, x in labels)
        rows.append((part or "", set(failures_of(text) + "E" * copied), good, toxic))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [r for r in own if f in r[1] and not r[1] & before]
                shapley[part, f] += len(gone)
                out.append(
                    (
                        part,
                        order,
                        step,
                        sum(not r[1] & (before | {f}) for r in own),
                        len(gone),
                        sum(f in r[1] and bool(r[1] & before) for r in own),
                        sum(r[1] == {f} for r in own),
                        sum(r[2] for r in gone),
                        sum(r[3] for r in gone),
                    )
                )
    return {(*x, shapley[x[0], x[1][x[2] - 1]]) for x in out}


def judge(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("hot", [2, 1000])
def test_audit_equals_brute_force(spark, hot):
    many = " ".join(words(250, 2, size=100_000))
    few = " ".join(words(250, 2, size=50))
    texts = [t for _, t in edge_texts()] + [many, few, many + " #", many.upper(), "a|b", "AB"]
    rows = [(i, t, ("x", "y", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [(50 + i, many, "x") for i in range(9)] + [(70, few, "x"), (70, few, "y"), (70, few, "y")]
    rows += [(None, many, "x"), (None, None, "y"), (None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 80)] + [(51, None, None), (53, 0, 1), (None, 1, 1)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    counts = audit.failure_counts(with_clashes(docs), judge(spark, labels), hot=hot)
    got = [tuple(r) for r in audit.order_audit(counts).collect()]
    assert len(got) == len(set(got)) == 3 * 600
    labels = [x for x in labels if x[0] is not None]
    assert set(got) == brute_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    one = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert audit.audit(none, judge(spark, [(1, 1, 0)])).count() == 0
    got = {tuple(r) for r in audit.audit(one, judge(spark, [])).collect()}
    assert got == brute_audit([(1, "a", "s")], [])


def test_equal_hashes_of_unlike_texts_are_no_copies(spark):
    rows = [(1, 7, "one"), (2, 7, "two"), (3, 7, "one"), (4, 8, "two"), (5, 8, "two")]
    docs = spark.createDataFrame(rows, "id long, hash long, text string")
    found = audit.with_smaller_copy(docs, docs.select("hash"), hot=1)
    assert sorted(r.id for r in found.collect()) == [3, 5]


def test_audit_is_not_quadratic_in_copies(spark):
    """The join hands each row one smallest id; a hot text is dealt out."""
    docs = spark.range(3000).select("id", F.lit(1).cast("long").alias("hash"), F.lit("same").alias("text"))
    found = audit.with_smaller_copy(docs, docs.select("hash"), hot=100)
    assert found.count() == 2999
