"""Each corpus operator against a plain version, on real small tables and on edge rows."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from buyerscope.llm import decontamination, mixing, pii, quality, queries, rollups, sharding, simhash, token_files, toxicity, warc
from buyerscope.llm.common import table
from buyerscope.llm.shared_files import new_folder
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
TINY_WORDS = "alpha beta gamma delta epsilon zeta eta theta".split()


def _texts() -> list:
    """Texts with every odd case that the operators must take."""
    rng = random.Random(5)
    line = lambda n: " ".join(rng.choice(TINY_WORDS) + rng.choice(TINY_WORDS) for _ in range(n))
    copy, long = line(60), line(30_000)
    near = copy.split()
    near[30] = "changed"
    return [
        None, "", " \t\n ", "one", "two words", copy, copy, " ".join(near), long, "x" * 200_000, "same " * 3000, line(25) + "\n" + line(3),
        "\n".join([line(9)] * 6), "a@b.co c@d.e@f.g 1.2.3.4.5.6.7.8 +1 (988) 555-2485 4337166598464399 <|endoftext|> it's Ünï 42",
    ]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated rows, ties, and columns named like the operators' own."""
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None, "S0")[i % 4], len(t or "")) for i, t in enumerate(_texts())]
    rows += [rows[5], rows[5], (None, "text without an id", None, None, None), (None, None, None, None, None)]
    extra = ("shard", "slot", "score", "size", "row", "key", "src", "fp", "copies", "u", "hash", "id", "toxic", "own_id")
    wide = [(*r, *range(len(extra))) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{e} int" for e in extra)
    return spark.createDataFrame(wide, schema)


@pytest.fixture(scope="module")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def none_last(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


# --- op6


def found_components(df):
    from pyspark.sql import functions as F

    out = simhash.near_duplicates(df).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    return none_last(tuple(r) for r in out.collect())


def test_simhash_matches_all_pairs(docs, odd):
    for df in (docs, odd):
        assert found_components(df) == none_last(brute.simhash(pairs(df)))


def test_simhash_of_nothing(empty):
    assert found_components(empty) == []
    assert simhash.keep_one(empty).collect() == []


def test_keep_one_keeps_one_row_of_each_component(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    by = {}
    for (d, f, c), (_, t) in zip(brute.simhash(pairs(odd)), pairs(odd)):
        by.setdefault(c if c is not None else f, []).append(d)
    expected = sorted(min((d for d in ids if d is not None), default=-1) for ids in by.values())
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == expected


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.booleans())
def test_every_link_shares_a_variant(value, bits, blocks):
    other = value
    for b in bits:
        other ^= 1 << b

    def keys(x):
        out = set()
        for low, width in simhash.SEGMENTS:
            part = x >> low & ((1 << width) - 1)
            rest = [b for b in range(64) if not low <= b < low + width]
            for bit in range(width):
                for j in range(5 if blocks else 1):
                    mask = sum(1 << b for b in rest[j::5]) if blocks else 0
                    out.add((low + bit, part & ~(1 << bit), j, x & mask))
        return out

    assert keys(value) & keys(other)


def test_lengthened_keys_find_the_same(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(60)]
    fps = {b ^ sum(1 << x for x in rng.sample(range(63), rng.randint(0, 5))) for b in base for _ in range(12)}
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    plain = {tuple(r) for r in simhash.components(simhash.links(rows)).collect()}
    monkeypatch.setattr(simhash, "OCCUPANCY", 0)
    assert {tuple(r) for r in simhash.components(simhash.links(rows)).collect()} == plain
    assert plain


def test_a_long_run_keeps_its_components():
    import numpy as np

    rng = random.Random(1)
    fps = np.array(sorted({0b1111 << 40 ^ sum(1 << x for x in rng.sample(range(22, 40), 3)) for _ in range(400)}), np.int64)
    links = simhash.run_links(np.zeros(len(fps), np.int64), fps)
    sets, all_sets = simhash._Sets(), simhash._Sets()
    for a, b in links.tolist():
        sets.joins(a, b)
    for i, a in enumerate(fps.tolist()):
        for b in fps.tolist()[:i]:
            if (a ^ b).bit_count() <= 4:
                all_sets.joins(a, b)
    assert [sets.top(f) for f in fps.tolist()] == [all_sets.top(f) for f in fps.tolist()]


# --- op3


def test_quality_matches_plain_counts(docs, odd):
    for df in (docs, odd):
        texts = {(r.doc_id, r.text) for r in df.collect()}
        for i, t in texts:
            if t and len(t) > 40_000:
                continue
            got = {k: v[0] for k, v in quality.measure([(t or "").encode()]).items()}
            want = brute.quality(t)
            if want["longest_repeat"] is None:
                want.pop("longest_repeat")
            assert {k: got[k] for k in want} == want
            assert not (got["base_failed"] and got["kept"])


def test_quality_is_the_same_in_a_batch(docs):
    texts = [(r.text or "").encode() for r in docs.collect()]
    alone = [quality.measure([t]) for t in texts]
    together = quality.measure(texts)
    assert {k: [a[k][0] for a in alone] for k in together} == together


def test_quality_rows(odd, empty):
    assert quality.judge(odd).count() == odd.count()
    assert quality.judge(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_maximal_repeats_match_brute_force(letters):
    import numpy as np

    tokens = np.array([ord(c) for c in letters], np.int64)
    order, prefix = quality.suffix_array(tokens)
    assert order.tolist() == sorted(range(len(letters)), key=lambda i: letters[i:])
    got = {(tuple(letters[order[a] : order[a] + k]), b - a + 1) for k, a, b in quality.maximal_repeats(tokens, order, prefix, 2)}
    want = set()
    for k in range(2, len(letters)):
        places = {}
        for i in range(len(letters) - k + 1):
            places.setdefault(tuple(letters[i : i + k]), []).append(i)
        for s, at in places.items():
            left = {letters[i - 1] if i else None for i in at}
            right = {letters[i + k] if i + k < len(letters) else None for i in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                want.add((s, len(at)))
    assert got == want


# --- op7


def test_pii_base_matches_plain_expressions(docs, odd):
    for df in (docs, odd):
        for _, t in pairs(df):
            if t and len(t) > 100_000:
                continue
            base, every = pii.spans(t or "")
            assert base == brute.base_spans(t)
            assert set(base) <= set(every)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1.@+-( )5", max_size=60))
def test_pii_base_on_dense_texts(text):
    assert pii.spans(text)[0] == brute.base_spans(text)


def test_pii_method_adds_checked_spans():
    text = "Pay to IBAN GB82 WEST 1234 5698 7654 32 today. Call my phone 030 555 1234." + " and so on" * 6 + " Order 030 555 1234."
    kinds = [(k, text[a:b]) for a, b, k in pii.spans(text)[1]]
    assert kinds == [("iban", "GB82 WEST 1234 5698 7654 32"), ("phone", "030 555 1234")]
    assert "iban" not in {k for _, _, k in pii.spans(text.replace("82 WEST", "83 WEST"))[1]}


def test_pii_takes_linear_time_and_all_rows(odd, empty):
    import time

    start = time.time()
    pii.spans("a" * 300_000)
    pii.spans("1" * 300_000 + "." * 10)
    pii.spans("+1" * 100_000)
    assert time.time() - start < 10
    assert pii.find(odd).count() == odd.count()
    assert pii.find(empty).collect() == []


# --- op4


def test_tokens_match_whole_texts(docs, odd):
    path = pytest.importorskip("public_tokenizers").path(queries.TOKENIZER)
    from pyspark.sql import functions as F

    for df in (docs, odd):
        got = token_files.read(token_files.write(df, path)).select("doc_id", "start", "n_tokens", F.crc32("ids"))
        got = sorted((tuple(r) for r in got.collect()), key=lambda r: r[1])
        ids = [r[0] for r in got]
        assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
        rows = sorted(((i, t) for i, t in pairs(df) if i is not None), key=lambda r: r[0])
        assert [r for r in got if r[0] is not None] == brute.tokens(rows, path)
        assert len(got) == df.count()


def test_tokens_of_nothing(empty):
    path = pytest.importorskip("public_tokenizers").path(queries.TOKENIZER)
    assert token_files.read(token_files.write(empty, path)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_pieces_give_the_ids_of_the_whole(texts):
    encoder = _encoder()
    assert encoder.encode([t.encode() for t in texts]) == encoder._plain(texts)


_kept = []


def _encoder():
    if not _kept:
        _kept.append(token_files.Encoder(pytest.importorskip("public_tokenizers").path(queries.TOKENIZER)))
        assert _kept[0].by_piece
    return _kept[0]


def test_other_tokenizers_take_whole_texts():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path)
    assert not encoder.by_piece
    assert encoder.encode([b"Two words."]) == encoder._plain(["Two words."])


# --- op5


def test_warc_round_trip(spark):
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(["<p>x</p>", None, "", "ä\r\n\r\nb", "<p>x</p>", "<p>x</p>", "z" * 300_000])]
    for source in (table(spark, SMALL, "pages").select("page_id", "url", "html"), spark.createDataFrame(rows, "page_id long, url string, html string")):
        want = brute.pages([(r.page_id, r.html) for r in source.collect()])
        captures = warc.assemble(warc.records(spark, warc.write(source)))
        assert captures.where("request is null or response is null or metadata is null").count() == 0
        assert none_last(tuple(r) for r in warc.payloads(captures).collect()) == none_last(want)


def test_warc_ties_nulls_and_nothing(spark):
    rows = [(7, None, "same"), (7, None, "same"), (None, "http://a\n/b", "same"), (None, None, None)]
    got = warc.payloads(warc.assemble(warc.records(spark, warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"))))).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [(0, "response", 0), (0, "revisit", 7), (7, "response", 0), (7, "revisit", 7)]
    assert warc.write(spark.createDataFrame([], "page_id long, url string, html string")) == []
    assert warc.assemble(warc.records(spark, [])).collect() == []


def test_warc_missing_partners_stay(spark):
    fields = ", ".join(f"{k} string" for k in warc.FIELDS) + ", block binary"
    row = lambda i, kind, to: (i, kind, to, None, "u", "d", "sha1:X", "t", b"")
    found = spark.createDataFrame([row("a", "response", None), row("b", "request", "lost"), row("c", "metadata", "a")], fields)
    got = {r.capture_id: (r.request is None, r.response is None, r.metadata is None) for r in warc.assemble(found).collect()}
    assert got == {"a": (True, False, False), "lost": (False, True, True)}


# --- op8


def test_rollup_commits_once_and_compacts(spark):
    rows = spark.createDataFrame([("s", None, "v", 5), ("s", None, "v", 7), (None, "en", "v", None)], "source string, lang string, version string, n_tokens long")
    totals = rollups.Rollup(spark, new_folder(spark, "rollup"))
    look = lambda: none_last(tuple(r) for r in totals.totals().collect())
    assert look() == []
    assert totals.commit("a", rollups.insert(rows)) and not totals.commit("a", rollups.insert(rows))
    first = [("s", None, "v", 2, 12), (None, "en", "v", 1, 0)]
    assert look() == first
    totals.compact()
    assert look() == first and not totals.commit("a", rollups.insert(rows))
    from pyspark.sql import functions as F

    assert totals.commit("b", rollups.revise(rows.withColumn("new_tokens", F.lit(10).cast("long"))))
    assert look() == [("s", None, "v", 2, 20), (None, "en", "v", 1, 10)]
    totals.compact()
    assert totals.commit("c", rollups.delete(rows.withColumn("n_tokens", F.lit(10).cast("long")))) and look() == []
    assert totals.commit("d", rollups.insert(rows.limit(0))) and all(map(totals.is_committed, "abcd")) and not totals.is_committed("e")
    with pytest.raises(ValueError):
        totals.commit("../x", rollups.insert(rows))


ROLLUP_ROWS = "source string, lang string, version string, n_tokens long"


def test_one_of_two_writers_commits(spark, monkeypatch):
    """Both look before either has committed; one more comes after the winner's batch was folded."""
    rows = spark.createDataFrame([("s", "en", "v", 5)], ROLLUP_ROWS)
    folder = new_folder(spark, "rollup")
    writers = [rollups.Rollup(spark, folder) for _ in range(8)]
    monkeypatch.setattr(rollups.Rollup, "is_committed", lambda self, name: False)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda w: w.commit("a", rollups.insert(rows)), writers))
    assert sorted(won) == [False] * 7 + [True]
    assert [r.tokens for r in writers[0].totals().collect()] == [5]
    assert writers[0].compact()
    assert not writers[1].commit("a", rollups.insert(rows))
    assert [r.tokens for r in writers[2].totals().collect()] == [5]
    assert writers[3].compact() and [r.tokens for r in writers[2].totals().collect()] == [5]


def test_a_batch_committed_while_folding_counts_once(spark, monkeypatch):
    rows = spark.createDataFrame([("s", "en", "v", 5)], ROLLUP_ROWS)
    folder = new_folder(spark, "rollup")
    one, two = rollups.Rollup(spark, folder), rollups.Rollup(spark, folder)
    one.commit("a", rollups.insert(rows))
    state = rollups.Rollup._state

    def slow(self):
        found = state(self)
        if self is one:
            assert two.commit("b", rollups.insert(rows))
        return found

    monkeypatch.setattr(rollups.Rollup, "_state", slow)
    assert one.compact()
    monkeypatch.undo()
    assert [(r.docs, r.tokens) for r in two.totals().collect()] == [(2, 10)]
    monkeypatch.setattr(rollups.Rollup, "_snapshot", lambda self: (0, None))
    assert not two.compact()  # snapshot 1 was published by the other
    monkeypatch.undo()
    assert [(r.docs, r.tokens) for r in one.totals().collect()] == [(2, 10)]


def brute_rollup(docs, labels):
    """Documents and tokens by key of what labels don't call bad, by the libraries alone."""
    import base64

    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    ranked = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    filed = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    bad = {r.doc_id for r in labels if r.quality == 0}
    sums = {}
    for r in docs:
        if r.doc_id is not None and r.doc_id in bad:
            continue
        text = r.text or ""
        for version, n in (("bytes-50k", len(ranked.encode_ordinary(text))), ("word-49k", len(filed.encode(text, add_special_tokens=False).ids))):
            old = sums.get((r.source, r.lang, version), (0, 0))
            sums[r.source, r.lang, version] = (old[0] + 1, old[1] + n)
    return none_last((*k, *v) for k, v in sums.items())


def test_rollup_query_counts_tokens(spark, tmp_path):
    docs = [(1, "Two words", "en", "web", 9), (2, None, None, None, None), (3, "", "en", "web", 0), (4, "x " * 60_000, "de", "web", 120_000),
            (4, "x " * 60_000, "de", "web", 120_000), (5, "bad one", "en", "web", 7), (None, "no key <|endoftext|> é", "fr", None, 20)]
    labels = [(5, 0, 0), (5, 0, 1), (1, 1, 0), (None, 0, 0)]
    for name, rows in (("full", docs), ("none", [])):
        d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        lab = spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int")
        d.withColumns({"version": d.text, "new_tokens": d.doc_id, "estimate": d.lang}).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        lab.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = queries.op8_delta_rollups(spark, f"{tmp_path}/{name}")
        assert got.columns == ["source", "lang", "version", "docs", "tokens"]
        assert none_last(tuple(r) for r in got.collect()) == brute_rollup(d.collect(), lab.collect())
    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet").collect() for t in ("documents", "labels"))
    assert none_last(tuple(r) for r in queries.op8_delta_rollups(spark, small).collect()) == brute_rollup(docs, labels)


# --- op2


def check_shards(rows, sizes, shards):
    """rows: (shard, slot); sizes alike."""
    total, load = sum(sizes), {}
    for (shard, slot), size in zip(rows, sizes):
        load.setdefault(shard, []).append((slot, size))
    for shard, own in load.items():
        assert sorted(s for s, _ in own) == list(range(len(own)))
        assert abs(sum(x for _, x in own) - total / shards) <= 2 * max(sizes)
    assert set(load) <= set(range(shards))


def test_shards_are_even(docs, odd, empty):
    for df, shards in ((docs, 24), (docs, 3), (odd, 2)):
        got = sharding.shard(df, shards)
        assert [c for c in got.columns if c not in ("shard", "slot")] == [c for c in df.columns if c not in ("shard", "slot")]
        rows = got.collect()
        assert len(rows) == df.count()
        check_shards([(r.shard, r.slot) for r in rows], [len((r.text or "").encode()) + 8 for r in rows], shards)
    assert sharding.shard(empty).collect() == []


def test_a_key_with_a_third_of_all_rows_is_split(spark):
    from pyspark.sql import functions as F

    df = spark.range(9000).select("id", F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).alias("doc_id"))
    df = df.select("doc_id", F.when(F.col("doc_id") == 1, F.lit("hot")).otherwise(F.col("doc_id").cast("string")).alias("text"))
    rows = sharding.shard(df, 12).collect()
    check_shards([(r.shard, r.slot) for r in rows], [len(r.text) + 8 for r in rows], 12)
    assert len({r.shard for r in rows if r.text == "hot"}) >= 3


# --- op10


def test_targets_fill_up_and_stop_at_the_cap():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 200.0, "b": 250 / 3, None: 500 / 3}
    assert sum(mixing.targets({"a": 10, "b": 1000}).values()) == pytest.approx(1515)
    assert mixing.targets({}) == {}


def test_mix_comes_near_the_targets(docs, odd):
    for df in (docs, odd):
        rows = mixing.copies(df, mixing.plan(df)).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
        assert len(rows) == df.count() and all(0 <= r.copies <= 2 for r in rows)
        for source in {r.source for r in rows}:
            own = [r for r in rows if r.source == source]
            assert sum(r.size for r in own) == own[0].source_size
            slack = max(r.size for r in own) * max(1, max(sum(1 for x in own if (x.doc_id, x.size) == (r.doc_id, r.size)) for r in own))
            assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= slack
        again = mixing.copies(df, mixing.plan(df)).select("row.doc_id", "copies").collect()
        assert sorted(map(str, again)) == sorted(f"Row(doc_id={r.doc_id}, copies={r.copies})" for r in rows)


def test_the_cut_equals_a_full_sort(docs):
    """The ranks taken are the smallest ones that come nearest to what the certain copies leave."""
    from pyspark.sql import functions as F

    plan = mixing.plan(docs)
    ranked = mixing._with(mixing._measured(docs), {s: v[2:] for s, v in plan.items()}, "c double, odds double, cut double")
    e = mixing._expected(F.col("c"))
    rows = ranked.select("src", "size", "cut", F.floor(e).alias("sure"), mixing._rank(F.col("c"), F.col("odds")).alias("rank")).collect()
    for s, (_, target, *_rest) in plan.items():
        own = [r for r in rows if r.src == s]
        left, sums = target - sum(r.sure * r["size"] for r in own), [0]
        order = sorted((r for r in own if r["rank"] is not None), key=lambda r: r["rank"])
        for r in order:
            sums.append(sums[-1] + r["size"])
        taken = sum(r["size"] for r in order if r["rank"] <= own[0].cut)
        assert abs(taken - left) <= min(abs(x - left) for x in sums) + 1e-6


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).collect() == []


# --- op9


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    found = {r.doc_id: r for r in toxicity.scores(docs, toxicity.fit(docs, labels)).collect()}
    assert len(found) == docs.count()
    held = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    # about one label in 25 of this table marks a text without anything toxic in it
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert sum(b > a for a, b in held) <= 0.01 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_toxicity_edge_rows(spark, odd, empty, docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    assert toxicity.scores(odd, toxicity.fit(odd, labels)).count() == odd.count()
    none = toxicity.fit(empty, labels.limit(0))
    assert {r.score for r in toxicity.scores(odd, none).collect()} == {0.0}
    assert toxicity.keep_civil(odd, none).count() == odd.count()
    assert toxicity.scores(empty, none).collect() == []


def test_held_out_rows_teach_nothing(spark, docs):
    from pyspark.sql import functions as F

    labels = table(spark, SMALL, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x) for x in (labels, turned))
    assert a.bias == b.bias and a.buckets.tolist() == b.buckets.tolist() and a.weights.tolist() == b.weights.tolist()


# --- op1


def leaks_by_brute_force(docs, items):
    out = set()
    for d, t in docs:
        w = decontamination.words_of((t or "").encode())
        for item in items:
            n = len(item.words)
            for at in range(0, len(w), decontamination.BLOCK):
                around = w[max(0, at - n) : at + 2 * decontamination.BLOCK + n]
                common = decontamination.common_subsequence(item.words, around)
                answered = item.answer and decontamination.common_subsequence(item.answer, around) >= decontamination.ANSWER * len(item.answer)
                if common >= decontamination.FULL * n or (answered and common >= decontamination.PARTLY * n):
                    out.add((d, item.item_id))
    return out


def test_leaks_match_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    items = decontamination.read_items(bench, 0, 1)
    short = [(r.doc_id, r.text) for r in docs.collect() if r.text and len(r.text) < 8000]
    want, kept = leaks_by_brute_force(short, items), {i for i, _ in short}
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect() if r.doc_id in kept}
    assert got <= want and len(got) >= 0.9 * len(want) > 0


def test_paraphrases_with_changed_words_are_found(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [" ".join(word() for _ in range(30)) + ". " + " ".join(word() for _ in range(5)) for _ in range(8)]
    rows = []
    for i, t in enumerate(items):
        w = t.split()
        for k in range(0, len(w), 6):
            w[k] = word()
        rows.append((i, " ".join([*(word() for _ in range(40 + 7 * i)), *w, *(word() for _ in range(50))])))
    rows += [(100 + i, " ".join(word() for _ in range(300))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == {(i, i) for i in range(8)}
    assert sorted(r.doc_id for r in decontamination.keep_clean(docs, bench).collect()) == list(range(100, 120))


def test_leaks_edge_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, _texts()[5]), (4, _texts()[5])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(odd, bench).collect()}
    assert got >= {(5, None), (5, 4), (6, 4), (7, 4)}
    assert decontamination.keep_clean(odd, bench).columns == odd.columns
    assert decontamination.leaks(empty, bench).collect() == []
    assert decontamination.leaks(odd, bench.limit(0)).collect() == []
    assert decontamination.keep_clean(odd, bench.limit(0)).count() == odd.count()


def test_rows_are_dropped_by_a_space_of_all_passages(spark, monkeypatch):
    seen, real = [], decontamination.latent_space

    def watched(passages, own, idf):
        seen.append(passages.count())
        return real(passages, own, idf)

    monkeypatch.setattr(decontamination, "FIT_BLOCKS", 1)
    monkeypatch.setattr(decontamination, "latent_space", watched)
    terms = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(terms))], "item_id long, text string")
    rows = [(i, " ".join([terms[(i + j) % 60] if j % 4 == 0 else f"x{i}y{j}" for j in range(48)])) for i in range(40)]
    docs = spark.createDataFrame([*rows, (99, " ".join(terms))], "doc_id long, text string")
    assert sorted(r.doc_id for r in decontamination.keep_clean(docs, bench).collect()) == list(range(40))
    assert seen == [40 * 3 + 4]


def test_the_index_is_fitted_on_all_passages(spark, monkeypatch):
    seen, real = [], decontamination.latent_space

    def watched(passages, own, idf):
        seen.append(passages.count())
        return real(passages, own, idf)

    monkeypatch.setattr(decontamination, "FIT_BLOCKS", 1)
    monkeypatch.setattr(decontamination, "HOT_TERMS", 20)
    monkeypatch.setattr(decontamination, "ROWS_AT_ONCE", 8)
    monkeypatch.setattr(decontamination, "latent_space", watched)
    terms = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(terms))], "item_id long, text string")
    rows = [(i, " ".join([terms[(i + j) % 60] if j % 4 == 0 else f"x{i}y{j}" for j in range(48)])) for i in range(40)]
    docs = spark.createDataFrame([*rows, (99, " ".join(terms))], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.n_common) for r in decontamination.leaks(docs, bench).collect()] == [(99, 1, 60)]
    assert seen == [40 * 3 + 4]


def test_tables_of_meetings_give_the_products_of_their_passages(monkeypatch):
    rng = np.random.default_rng(6)
    dense = rng.integers(0, 3, (200, 12)) * (rng.random((200, 12)) < 0.3)
    dense[np.arange(200), rng.integers(0, 12, 200)] += 1
    idf, right = rng.random(12) + 0.5, rng.normal(size=(12, 4))
    block, ids = np.nonzero(dense)
    begin = np.flatnonzero(np.r_[True, np.diff(block) > 0])
    want = np.zeros((12, 4))
    decontamination._add_products(want, ids, dense[block, ids], begin, idf, right)
    for hot in (12, 8, 1):
        monkeypatch.setattr(decontamination, "HOT_TERMS", hot)
        monkeypatch.setattr(decontamination, "ROWS_AT_ONCE", 5)
        met, got = decontamination.Meetings(idf), np.zeros((12, 4))
        for a in (0, 90):
            part = slice(begin[a], begin[90] if a == 0 else len(ids))
            own = begin[a : 90 if a == 0 else 200] - begin[a]
            rest = met.add(ids[part], dense[block, ids][part], own)
            assert hot < 12 or not len(rest[0])
            if len(rest[0]):
                decontamination._add_products(got, *rest, idf, right)
        got[met.hot] += met.product(right)
        assert np.allclose(got, want)


def test_rare_items_are_found_however_large_the_corpus(spark, monkeypatch):
    for name, value in (("FIT_BLOCKS", 20), ("OWN_WEIGHT", 10.0), ("RANK", 12), ("OVERSAMPLE", 2)):
        monkeypatch.setattr(decontamination, name, value)
    rng = random.Random(4)
    common = [f"c{i}" for i in range(40)]
    items = [" ".join(f"r{i}w{j}" for j in range(24)) for i in range(10)]
    bench = spark.createDataFrame([*enumerate(items), (10, " ".join(common))], "item_id long, text string")
    rows = [(100 + i, " ".join(rng.choice(common) if j % 2 else f"x{i}y{j}" for j in range(96))) for i in range(200)]
    planted = [(i, " ".join([f"x{i}a{j}" for j in range(20)] + [t] + [f"x{i}b{j}" for j in range(40)])) for i, t in enumerate(items)]
    docs = spark.createDataFrame(rows + planted, "doc_id long, text string")
    assert sorted(r.doc_id for r in decontamination.keep_clean(docs, bench).collect()) == [i for i, _ in rows]


def test_products_of_passages_are_those_of_their_matrix():
    rng = np.random.default_rng(5)
    dense = rng.integers(0, 3, (30, 12)) * (rng.random((30, 12)) < 0.4)
    dense[:, 0] += 1
    idf, right = rng.random(12) + 0.5, rng.normal(size=(12, 4))
    block, ids = np.nonzero(dense)
    out = np.zeros((12, 4))
    decontamination._add_products(out, ids, dense[block, ids], np.flatnonzero(np.r_[True, np.diff(block) > 0]), idf, right, 2.0)
    a = dense * idf
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    assert np.allclose(out, 2.0 * a.T @ (a @ right))
