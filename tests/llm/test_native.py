"""Quality rules and mixing: edge cases, and brute force where SQL is not the twin."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from neardup.llm import mixing, rules
from tests.llm.fixtures import documents, edge_texts, with_clashes, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    n = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = {i + k for i in range(len(ws) - 7) if n[tuple(ws[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(ws),
        sum(map(len, ws)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
        len(lines),
        text.count("!"),
    )


def test_measurements_equal_brute_force(spark):
    again = " ".join(words(30, 3))
    rows = [
        *edge_texts(),
        (20, f"{again} x {again}\n{again}\n\n{again}"),
        (21, "a " * 9),
        (22, "a b c d e f g h"),
        (23, "# * $ % & | < > !!! é\x1f x"),
        (24, " ".join(words(300, 4, size=3))),
    ]
    docs = with_clashes(documents(spark, rows))
    got = Counter(
        (r.doc_id, tuple(r[c] for c in rules.MEASUREMENTS)) for r in rules.ledger(docs).collect()
    )
    assert got == Counter((i, brute(t)) for i, t in rows)


def test_policies_and_ablations_follow_from_the_bits(spark):
    bits = [0, 1, 2, 3, 4, 8, 36, 32]
    led = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id long, fail_bits long")
    v1 = rules.POLICIES["v1"]
    kept = {r.doc_id: (r.kept, r.only_rule) for r in rules.apply_policy(led, v1).collect()}
    assert kept[0] == (True, None) and kept[5] == (True, None) and kept[3] == (False, None)
    assert kept[4] == (False, "symbols") and kept[7] == (False, "exclamations")
    counts = {r.rule: (r.n_failed, r.n_regained) for r in rules.ablations(led, v1).collect()}
    assert counts == {
        "few_words": (2, 1),
        "repeated_windows": (2, 1),
        "symbols": (2, 1),
        "exclamations": (2, 1),
    }


def test_rules_keep_columns_and_stand_empty_tables(spark):
    docs = with_clashes(documents(spark, edge_texts()))
    kept = rules.keep_passing(docs, rules.BASE)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id}) == [1, 2]
    none = documents(spark, []).where("false")
    assert rules.ledger(none).count() == 0 and rules.keep_passing(none, rules.BASE).count() == 0
    assert rules.ablations(rules.ledger(none), rules.BASE).count() == 0


def fill(budget, children):
    """Children {name: (weight, capacity)}: water filling, one child at a time."""
    out, left, open_ = {}, budget, dict(children)
    while open_:
        w = sum(w for w, _ in open_.values())
        full = {k for k, (v, c) in open_.items() if v and c * w <= left * v}
        if not full:
            return out | {k: left * v // w if v else 0 for k, (v, _) in open_.items()}
        for k in full:
            out[k] = open_.pop(k)[1]
        left = budget - sum(c for k, (_, c) in children.items() if k in out)
    return out


@pytest.mark.parametrize("percent,epochs,floor", [(40, 1, 0), (90, 2, 0), (125, 2, 1), (500, 1, 0)])
def test_budgets_and_prefixes(spark, percent, epochs, floor):
    rows = []
    for i in range(400):
        lang, src = ("en", "src1") if i % 3 else ("de", f"src{i % 5}")
        rows.append((i, " ".join(words(1 + i % 40, i)), lang, src, 0))
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    mix = mixing.Mix(
        ("lang", "source"), {("de",): 3, ("de", "src0"): 5}, 1, percent, epochs, floor, seed=5
    )
    got = mixing.with_copies(with_clashes(docs), mix, copies_col="taken", tokens_col="tokens").collect()
    assert len(got) == len(rows)
    tokens, taken = Counter(), Counter()
    for r in got:
        tokens[r.lang, r.source] += r.tokens
        taken[r.lang, r.source] += r.tokens * r.taken
        assert floor <= r.taken <= epochs
    total = sum(tokens.values())
    spare = epochs - floor
    langs = {}
    for (lang, _), n in tokens.items():
        langs[lang] = langs.get(lang, 0) + n * spare
    budget = max(0, total * percent // 100 - total * floor)
    at = fill(budget, {k: ({"de": 3}.get(k, 1), c) for k, c in langs.items()})
    for lang in langs:
        leaves = {
            k: (5 if k == ("de", "src0") else 1, n * spare)
            for k, n in tokens.items()
            if k[0] == lang
        }
        for leaf, b in fill(at[lang], leaves).items():
            want = b + tokens[leaf] * floor
            # A prefix ends within the tokens of one document.
            assert want - 40 <= taken[leaf] <= want


def between(budget, children):
    """Children {name: (weight, least, most)}: the level by bisection."""
    budget = min(max(budget, sum(a for _, a, _ in children.values())), sum(c for *_, c in children.values()))
    low, high = 0.0, 1e9
    for _ in range(200):
        t = (low + high) / 2
        full = sum(min(max(w * t, a), c) for w, a, c in children.values()) >= budget
        low, high = (low, t) if full else (t, high)
    return {k: min(max(w * high, a), c) for k, (w, a, c) in children.items()}


@pytest.mark.parametrize("percent,epochs,floor", [(125, 2, 1), (160, 3, 1)])
def test_a_floor_counts_against_the_target(spark, percent, epochs, floor):
    rows = []
    for i in range(600):
        lang, src = ("en", "src1") if i % 3 else (f"l{i % 4}", f"src{i % 5}")
        rows.append((i, " ".join(words(1 + i % 40, i)), lang, src, 0))
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    weights = {("l1",): 3, ("l1", "src0"): 5, ("l2", "src3"): 0}
    mix = mixing.Mix(("lang", "source"), weights, 1, percent, epochs, floor, 5, floor_counts=True)
    got = mixing.with_copies(docs, mix, copies_col="taken", tokens_col="tokens").collect()
    tokens, taken, langs = Counter(), Counter(), Counter()
    for r in got:
        tokens[r.lang, r.source] += r.tokens
        taken[r.lang, r.source] += r.tokens * r.taken
        langs[r.lang] += r.tokens
        assert floor <= r.taken <= epochs
    total = sum(tokens.values())
    at = between(
        total * percent // 100,
        {k: (weights.get((k,), 1), n * floor, n * epochs) for k, n in langs.items()},
    )
    for lang in langs:
        leaves = {
            k: (weights.get(k, 1), n * floor, n * epochs) for k, n in tokens.items() if k[0] == lang
        }
        for leaf, want in between(at[lang], leaves).items():
            if weights.get(leaf) == 0:
                assert taken[leaf] == tokens[leaf] * floor
            elif ("l2", "src3") not in leaves or percent < 200:
                assert want - 42 <= taken[leaf] <= want + 1
    if percent != 125:
        return
    assert taken["en", "src1"] == tokens["en", "src1"]  # far beyond its target
    reached = {tuple(r.path): r for r in mixing.shares(docs, mix, 1).collect()}
    assert {k: r.tokens for (k,), r in reached.items()} == langs
    every = 3 + len(langs) - 1
    for (lang,), r in reached.items():
        assert r.taken == sum(n for k, n in taken.items() if k[0] == lang)
        assert abs(r.target - weights.get((lang,), 1) / every) < 1e-9
        assert abs(r.reached - r.taken / sum(taken.values())) < 1e-9
    none = docs.where("false")
    assert mixing.mixed_rows(none, mix).count() == 0 and mixing.shares(none, mix).count() == 0


def test_mixing_edge_cases(spark):
    mix = mixing.Mix(("lang", "source"), budget_percent=150, max_epochs=2, floor_epochs=1)
    docs = with_clashes(documents(spark, edge_texts()))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 3, F.col("lang")))
    out = mixing.mixed_rows(docs, mix)
    assert out.columns == docs.columns and out.count() >= docs.count()
    again = mixing.mixed_rows(docs.repartition(5), mix)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert mixing.mixed_rows(documents(spark, []).where("false"), mix).count() == 0
    with pytest.raises(ValueError):
        mixing.Mix(("lang",), max_epochs=1, floor_epochs=2)


def test_a_filter_measures_each_text_once(spark):
    docs = documents(spark, edge_texts())
    plan = rules.keep_passing(docs, rules.POLICIES["v1"])._jdf.queryExecution().optimizedPlan().toString()
    # Words and lines are split once, hashes joined for 2, 4 and 8 words.
    assert plan.count("split(") == 2 and plan.count("xxhash64") == 3
    led = rules.apply_policy(rules.ledger(docs), rules.POLICIES["v1"])
    kept = Counter((r.doc_id, r.text) for r in rules.keep_passing(with_clashes(docs), rules.POLICIES["v1"]).collect())
    assert sum(kept.values()) == led.where("kept").count()
