"""Fill-in-middle, importance resampling and the quality classifier against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from buyerscope.llm import fill_middle, importance, quality_model, queries, sharding
from buyerscope.llm.common import table
from buyerscope.sources.staging import staged
from tests.llm.test_corpus_operators import SMALL, _texts, none_last

# --- edge rows


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated rows, long texts, and columns named like the operators' own."""
    texts = [*_texts(), "a <P> in it", "ends <S", "S> begins", "é" * 3000 + "\n\n\nü w", "  lead \n\n x"]
    rows = [(i, t, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "text without an id " * 9, None), (None, None, None)]
    extra = ("N", "form", "Output", "output", "row", "line", "weight", "rank", "score", "shard", "good", "key", "id", "text2", "_x")
    extra = tuple(dict.fromkeys(e.lower() for e in extra))
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"{e} int" for e in extra)
    return spark.createDataFrame([(*r, *range(len(extra))) for r in rows], schema)


@pytest.fixture(scope="module")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- op11

UNIT = {"char": r"(?s).", "word": r"(?s)^[\t-\r ]*[^\t-\r ]+[\t-\r ]*|^[\t-\r ]+|[^\t-\r ]+[\t-\r ]*", "line": r"[^\n]*\n|[^\n]+"}


def cut_plainly(doc_id, text, unit="char", seed=1):
    t = text or ""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(UNIT[unit], t)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", sorted(UNIT))
def test_cuts_match_plain_code_and_come_back(docs, odd, unit):
    for df in (docs, odd):
        out = fill_middle.rearranged(df, unit)
        columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
        rows = out.select(*columns, fill_middle.restored().alias("back")).collect()
        texts = pairs(df)
        assert none_last(tuple(r)[:6] for r in rows) == none_last(cut_plainly(i, t, unit) for i, t in texts)
        assert sorted(r.back for r in rows) == sorted(t or "" for _, t in texts)
    kept = [c for c in odd.columns if c not in ("text", "n", "form", "output")]
    assert fill_middle.rearranged(odd).columns == [*kept, "n", "form", "prefix_chars", "middle_chars", "output"]


def test_nothing_is_cut_from_an_empty_table(empty):
    assert fill_middle.rearranged(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab é€\n\t𝄞", max_size=60), max_size=6), st.sampled_from(sorted(UNIT)), st.integers(1, 9))
def test_every_cut_of_a_forest(texts, unit, block):
    raw = [t.encode() for t in texts]
    forest = fill_middle.Forest(raw, unit, block)
    split = [re.findall(UNIT[unit], t) for t in texts]
    assert forest.n_units.tolist() == [len(u) for u in split]
    assert forest.n_chars.tolist() == [len(t) for t in texts]
    asked = [(i, k) for i, u in enumerate(split) for k in range(len(u) + 1)]
    if asked:
        byte, char = forest.cut(*(np.array(x) for x in zip(*asked)))
        heads = ["".join(split[i][:k]) for i, k in asked]
        assert byte.tolist() == [len(h.encode()) for h in heads]
        assert char.tolist() == [len(h) for h in heads]


def test_sentinels_that_overlap_are_refused(docs):
    for bad in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("ab", "ba", "c"), ("", "<S>", "<M>"), ("<P>", "x<P>y", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.rearranged(docs, sentinels=bad)
    with pytest.raises(ValueError):
        fill_middle.Forest([b"x"], "byte")


def test_a_long_text_among_short_ones():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aé \n") for _ in range(n)) for n in (0, 300_000, 1, 7, 511, 512, 513)]
    forest = fill_middle.Forest([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for k in {0, len(t) // 3, len(t)}:
            byte, char = forest.cut(np.array([i]), np.array([k]))
            assert (byte[0], char[0]) == (len(t[:k].encode()), k)


# --- op12

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    w = FEATURE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def resampled_plainly(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, longest)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        n, found = features(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = place + 1
    return none_last(tuple(r) for r in out)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (2, 500, 40), (3, 97, 100)])
def test_resampling_matches_plain_code(spark, docs, odd, longest, buckets, percent):
    target = table(spark, SMALL, "benchmark")
    items = [r.text for r in target.collect()]
    for df in (docs, odd):
        got = importance.scores(df, target, buckets, longest, percent)
        assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
        assert none_last(tuple(r) for r in got.collect()) == resampled_plainly(pairs(df), items, longest, buckets, percent)


def test_resampling_of_empty_tables(spark, docs, empty):
    assert importance.scores(empty, table(spark, SMALL, "benchmark")).collect() == []
    got = importance.scores(docs, empty)
    assert none_last(tuple(r) for r in got.collect()) == resampled_plainly(pairs(docs), [])


def test_drawn_documents_have_all_columns(odd, docs):
    scored = staged(importance.scores(docs, docs, percent=25))
    kept = importance.drawn(docs, scored)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.where("rank is not null").collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=4), max_size=5), st.integers(1, 5))
def test_lines_and_crossings_hold_every_feature(lines, longest):
    hasher = importance.Hasher(1 << 30, longest)
    words = [w for line in lines for w in line]
    whole = sorted(hasher.line(words))
    assert sorted([b for line in lines for b in hasher.line(line)] + hasher.across(lines)) == whole


# --- op13


def test_one_update_by_hand():
    sums = quality_model.Sums()
    sums.learn(np.array([3, 5]), np.array([0.6, 0.8]), 1.0)
    # all weights are 0, so p = 0.5 and each gradient is -0.5 times the value; the bias has value 1
    assert sums.z[[3, 5, quality_model.BUCKETS]].tolist() == pytest.approx([-0.3, -0.4, -0.5])
    assert sums.n[[3, 5, quality_model.BUCKETS]].tolist() == pytest.approx([0.09, 0.16, 0.25])
    a, b, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2
    assert sums.weights(np.array([5]))[0] == pytest.approx((0.4 - l1) / ((b + 0.4) / a + l2))
    assert sums.weights(np.array([4]))[0] == 0.0


def test_updates_match_a_plain_loop():
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 30, 8)), int(rng.integers(0, 2))) for _ in range(200)]
    sums, z, n = quality_model.Sums(), {}, {}
    a, b, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2
    for at, good in rows:
        x = np.full(len(at), 1 / math.sqrt(len(at)))
        sums.learn(at, x, good)
        feats = [*zip(at.tolist(), x.tolist()), ("bias", 1.0)]
        w = {f: 0.0 if abs(z.get(f, 0)) <= l1 else -(z[f] - math.copysign(l1, z[f])) / ((b + math.sqrt(n[f])) / a + l2) for f, _ in feats}
        p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in feats)))
        for f, v in feats:
            g = (p - good) * v
            sigma = (math.sqrt(n.get(f, 0) + g * g) - math.sqrt(n.get(f, 0))) / a
            z[f], n[f] = z.get(f, 0) + g - sigma * w[f], n.get(f, 0) + g * g
    assert sums.z[:30].tolist() == pytest.approx([z.get(i, 0.0) for i in range(30)])
    assert sums.z[-1] == pytest.approx(z["bias"])


def test_vectors_have_length_one_whatever_stands_beside():
    texts = [b"", b"One two!! TWO", b"x x x x", "Ünï 42 | a".encode(), b" \n "]
    bucket, value, edge = quality_model.Vectors()(texts)
    for i, t in enumerate(texts):
        own = slice(edge[i], edge[i + 1])
        alone = quality_model.Vectors()([t])
        assert bucket[own].tolist() == alone[0].tolist() and value[own].tolist() == alone[1].tolist()
        assert math.isclose(float(value[own] @ value[own]), 1.0) if t.split() else own.start == own.stop
    assert edge[2] - edge[1] == 4 + 3 - 1  # one, two, !!, and their pairs; "two" twice


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    found = {r.doc_id: r for r in quality_model.scores(docs, quality_model.fit(docs, labels)).collect()}
    pairs = [(r.quality, found[r.doc_id]) for r in labels.collect() if r.doc_id in found]
    apart = [(q, r) for q, r in pairs if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for _, r in pairs)
    assert sum(q == r.predicted for q, r in apart) / len(apart) > 0.97
    assert sum(r.predicted for q, r in apart if q) / sum(q for q, _ in apart) > 0.98


def test_held_out_labels_are_not_learned_from(spark, docs):
    labels = table(spark, SMALL, "labels")
    turned = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_model.fit(docs, labels), quality_model.fit(docs, turned)
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights)


def test_refits_agree_on_other_partitions(spark, docs):
    labels = table(spark, SMALL, "labels")
    a, b = quality_model.fit(docs, labels), quality_model.fit(docs.repartition(13), labels.repartition(5))
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights)


def test_quality_defined_cases(spark, docs, odd, empty):
    labels = table(spark, SMALL, "labels")
    model = quality_model.fit(docs, labels)
    rows = quality_model.scores(odd, model).collect()
    assert len(rows) == odd.count()
    bias = 1 / (1 + math.exp(-model.bias))
    of = {r.doc_id: r for r in rows}
    assert of[0].score == of[1].score == of[2].score == bias
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert quality_model.scores(empty, model).collect() == []
    none = labels.where("false")
    assert {r.score for r in quality_model.scores(odd, quality_model.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality_model.scores(odd, quality_model.fit(docs, labels.where("quality = 1"))).collect()} == {1.0}
    assert {r.score for r in quality_model.scores(odd, quality_model.fit(empty, labels)).collect()} == {0.5}
    marks = spark.createDataFrame([(5, 1), (5, 1), (5, 0), (6, 0), (None, 1), (7, None), (7, 9), (99, 1), (9, 0)], "doc_id long, quality int")
    assert {(r.good, r.shard >= 0) for r in quality_model.training_rows(odd, marks).collect()} <= {(0, True), (1, True)}
    ids = quality_model.training_rows(odd, marks)
    assert ids.count() == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in (5, 6, 9))


# --- op2


def test_equal_rows_in_many_partitions_have_places_of_their_own(spark):
    rows = spark.range(0, 300, 1, 300).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same").alias("text"))
    got = sharding.shard(rows, 5).collect()
    places = sorted((r.shard, r.slot) for r in got)
    assert places == [(k, i) for k in range(5) for i in range(60)]


# --- the queries


def test_queries_return_the_contract(spark):
    schema = lambda name: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.QUERIES[name](spark, SMALL).schema)
    assert schema("op11_fenwick_cuts") == (
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    )
    assert schema("op12_segment_deduplication") == "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint"
    assert schema("op13_follow_the_regularised_leader") == "doc_id bigint, held_out boolean, score double, predicted int"


def test_query_of_importance_matches_plain_code(spark, docs):
    got = queries.op12_segment_deduplication(spark, SMALL).collect()
    want = resampled_plainly(pairs(docs), [r.text for r in table(spark, SMALL, "benchmark").collect()])
    assert none_last(tuple(r) for r in got) == none_last((i, f, w, s, k) for i, _, f, w, s, k in want)
