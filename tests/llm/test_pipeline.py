"""Each stage of the pipeline, and the whole, against brute force on a small table."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.conftest import words
from tests.llm.test_operators import brute_components, brute_template_lines, targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows(docs):
    rng = np.random.default_rng(31)
    own = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    found = [tuple(r) for r in docs.filter("doc_id % 5 = 0").collect()]
    notice = own(14)
    for k in range(30):  # unrelated texts with a notice; some with CRLF
        found.append((50000 + k, ("\r\n" if k % 3 else "\n").join([own(30), own(30), notice, own(30)]), "en", "ab"[k % 2], None))
    base = own(200).split(" ")
    for k in range(40):  # near copies, exact copies, and some without an id
        copy = list(base)
        copy[int(rng.integers(0, 200))] = f"x{k}"
        found.append((60000 + k if k % 4 else None, " ".join(copy if k % 5 else base), "en", None, 7))
    found += [(None, own(40), "en", "a", 1), (None, own(40), "en", "a", 1), (71, "", "en", "a", 0), (72, None, "en", "a", 0), (73, "12 34 -- ½", "en", "a", 0), (74, "same words here", "de", "z", 0), (74, "same words here", "de", "z", 0), (74, own(30), "de", "z", 0), (75, own(6000), None, "z", 0)]
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*")


def bag(df):
    return Counter(map(tuple, df.select(*P.COLUMNS).collect()))


def test_language_stage(spark, rows):
    got = P.language_id(spark, frame(spark, rows), "").collect()
    want = Counter((r[0], r[1], r[3], r[4]) for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert Counter((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in got) == want and all(r["lang"] != "und" for r in got)
    bare = [(i, t, None, s, n) for i, t, _, s, n in rows]
    assert Counter(r["text"] for r in P.language_id(spark, frame(spark, bare), "").collect()) == Counter(t for _, t, *_ in rows if any(c.isalpha() for c in t or ""))


def test_line_stage(spark, rows):
    own = [r for r in rows if r[0] is not None and (50000 <= r[0] < 60000 or r[0] < 80)]
    new = brute_template_lines([r[1] for r in own])
    want = Counter((r[0], t, r[2], r[3], len(t) if t != r[1] else r[4]) for r, t in zip(own, new, strict=True))
    assert bag(P.line_dedup(spark, frame(spark, own), "")) == want and sum(t != r[1] for r, t in zip(own, new, strict=True)) >= 30


def test_near_duplicate_stage(spark, rows):
    """One document of each group stays, the one with the least id; whatever has no words stays."""
    got = bag(P.near_duplicates(spark, frame(spark, rows), ""))
    assert set(got) <= set(map(tuple, rows)) and set(got.values()) == {1}
    texts = sorted({t for _, t, *_ in rows if words(t)})
    # brute_components gives its classes for text numbers; equal texts are one.
    group = {}
    for number, _, least in brute_components(list(enumerate(texts))):
        group[texts[number]] = least
    want = {}
    for i, t, *_ in rows:
        if words(t):
            rank = (i is None, i or 0)
            want[group[t]] = min(rank, want.get(group[t], rank))
    kept = Counter((group[t], (i is None, i or 0)) for i, t, *_ in got if words(t))
    assert kept == Counter(want.items())
    assert Counter((i, t) for i, t, *_ in got if not words(t)) == Counter({(i, t) for i, t, *_ in rows if not words(t)})


def test_mixing_stage(spark, rows):
    got = bag(P.mixing(spark, frame(spark, rows), ""))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    have = Counter()
    for (_, t, _, s, _), n in got.items():
        have[s] += n * len(words(t))
    goal = targets(sizes)
    longest = max(len(words(t)) for _, t, *_ in rows)
    assert set(got) <= set(map(tuple, rows))
    assert all(abs(have[s] - goal[s]) <= max(0.15 * goal[s], longest) for s in goal)
    for r, n in got.items():
        assert n <= 3 * sum(tuple(x) == r for x in rows)


def test_run(spark, rows, tmp_path):
    """The whole equals its stages one after another; all ids of what the mix plays are packed."""
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = P.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == P.COLUMNS
    from terrafold.llm.token_count import token_counts

    want = Counter()
    for r in token_counts(docs).collect():
        want[r["doc_id"]] += r["n_tokens"] + 1
    got = Counter()
    for p in pieces:
        got[p["doc_id"]] += p["length"]
    assert got == want


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, none, "").collect() == []
