import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from helpers import clashing, empty_documents, odd_documents, prose
from pyspark.sql import functions as F

from tidemark.llm import near_dedup, substrings
from tidemark.llm.components import components
from tidemark.session import scratch_root, settings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_passages(texts, size):
    said = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + size]) for w in said for i in range(len(w) - size + 1))
    out = []
    for w in said:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def passages(spark):
    rng = random.Random(9)
    base, other = prose(rng, 300).split(), prose(rng, 120).split()
    texts = [
        " ".join(base), " ".join(base), "\n".join(base[:80] + other),  # copies, and a part elsewhere
        " ".join(base[10:44]), " ".join(base[10:45]),  # one word short of a window, and just one
        "  ".join(other[:60] + ["x"] + other[61:]),  # broken by one word
        " ".join(["to", "fro"] * 300), " ".join(["to", "fro"] * 20),  # repeats itself
        " ".join(other[20:70] + ["gap"] * 3 + other[20:70]),
        " ".join(["same"] * 35), " ".join(["once"] * 36),
        None, "", "\xa0".join(base[:40]),  # a no-break space does not part words
        prose(rng, 40_000) + " " + " ".join(base[100:200]),
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


def test_passages_against_brute_force(spark):
    docs, texts = passages(spark)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substrings.dedup(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, 35)


def test_passages_of_another_size(spark):
    docs, texts = passages(spark)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substrings.dedup(docs, size=20, anchor=6).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, 20)


def test_passages_odd_rows(spark):
    docs = clashing(odd_documents(spark), "kept_text", "places", "n_words")
    got = substrings.dedup(docs)
    assert got.columns == [*odd_documents(spark).columns, "kept_text", "n_words", "n_removed"]
    rows = got.collect()
    assert len(rows) == 9 and all(r["n_removed"] == 0 for r in rows)
    assert {r["doc_id"]: r["n_words"] for r in rows}[4] == 60_000
    assert substrings.dedup(empty_documents(spark)).count() == 0


def test_repeated_rows_are_copies_of_each_other(spark):
    text = prose(random.Random(1), 50)
    docs = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    assert [r["n_removed"] for r in substrings.dedup(docs).collect()] == [50, 50, 50]


def brute_classes(rows, weight):
    sets = []
    for i, text in rows:
        w = WORD.findall(text or "")
        sets.append(Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = sum(weight(s) * min(n, sets[b][s]) for s, n in sets[a].items())
            whole = sum(weight(s) * n for s, n in sets[a].items()) + sum(weight(s) * n for s, n in sets[b].items()) - both
            if whole and both / whole >= 0.8 - 1e-9:
                root[find(a)] = find(b)
    out = defaultdict(list)
    for k in range(len(rows)):
        out[find(k)].append(k)
    return sorted(sorted(v) for v in out.values())


def near_copies():
    rng = random.Random(8)
    rows = []
    for group in range(25):
        base = prose(rng, rng.randint(30, 200)).split()
        for copy in range(rng.choice([1, 1, 2, 3, 8])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    rows += ["short", "short", "two words", "a b c d", "a b c d e", None, "", "   "]
    return list(enumerate(rows))


def test_classes_against_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = near_dedup.fit_weights(docs)
    # Fewer than a twentieth of the rows share a shingle here, so all weigh the same.
    assert len(weights.shingle) == 0 or weights.idf.min() > 0
    got = near_dedup.classes(docs).collect()
    assert len(got) == len(rows)
    found = defaultdict(list)
    for r in got:
        found[r["class_id"]].append(r["doc_id"])
    def frequency(s, said=[WORD.findall(t or "") for _, t in rows]):
        return sum(any(tuple(w[k : k + 5]) == s for k in range(max(1, len(w) - 4))) for w in said)

    memo = {}

    def weight(s):
        if s not in memo:
            import math

            memo[s] = 1 + math.log((1 + len(rows)) / (1 + max(frequency(s), near_dedup.SHARE * len(rows))))
        return memo[s]

    assert sorted(sorted(v) for v in found.values()) == brute_classes(rows, weight)
    assert all(r["class_id"] == min(found[r["class_id"]]) for r in got)
    assert all(r["class_size"] == len(found[r["class_id"]]) for r in got)


def test_near_copies_within_a_half_alike_family(spark):
    """Texts on one template share most buckets; the near copies among them are found all the same."""
    rng = random.Random(6)
    template, rows = prose(rng, 1000), []
    for _ in range(1500):
        rows.append(f"{template} {prose(rng, 18)}")
    for i in range(0, 600, 10):
        rows.append(" ".join([*rows[i].split()[:1003], prose(rng, 15)]))
    got = near_dedup.classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    found = defaultdict(set)
    for r in got:
        found[r["class_id"]].add(r["doc_id"])
    assert sorted(sorted(v) for v in found.values() if len(v) > 1) == [[10 * k, 1500 + k] for k in range(60)]


def test_one_stays_of_each_class(spark):
    rows = near_copies()
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string")
    classes = near_dedup.classes(docs).collect()
    kept = near_dedup.representatives(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["class_id"] for r in classes})


def test_classes_odd_rows(spark):
    rows = near_dedup.classes(clashing(odd_documents(spark), "class_id", "digest")).collect()
    assert len(rows) == 9
    assert sorted(r["class_size"] for r in rows) == [1] * 7 + [2, 2]
    kept = near_dedup.representatives(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and kept.count() == 8
    assert near_dedup.classes(empty_documents(spark)).count() == 0


def test_frequent_shingles_are_counted_exactly(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "one very common line of words " * (i % 3 == 0) + prose(rng, 20)) for i in range(300)], "doc_id long, text string").repartition(7)
    weights = near_dedup.fit_weights(docs)
    # The line has two shingles of its own; the one that runs into the next text differs each time.
    import math

    assert len(weights.shingle) == 2
    assert all(abs(w - (1 + math.log(301 / 101))) < 1e-12 for w in weights.idf)


def test_rare_shingles_have_frequencies_of_their_own(spark):
    """A passage in 4 % of the documents weighs less than text found once."""
    rng = random.Random(4)
    line = prose(rng, 30)
    docs = spark.createDataFrame([(i, (line + " ") * (i % 25 == 0) + prose(rng, 12)) for i in range(500)], "doc_id long, text string").repartition(5)
    import math

    weights = near_dedup.fit_weights(docs)
    assert len(weights.shingle) == 26 and abs(weights.common - (1 + math.log(501 / 2))) < 1e-12
    assert all(abs(w - (1 + math.log(501 / 21))) < 1e-12 for w in weights.idf)


def test_texts_not_asked_for_are_left_out_before_the_join(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(4000)], "doc_id long, text string")
    keyed = near_dedup._keyed(docs)
    distinct = keyed.select("digest", "doc_id", F.lit(b"df").alias("df"))
    asked = keyed.where("doc_id % 200 < 2").select("digest", "doc_id")
    near = near_dedup._likely(keyed, asked)
    assert near.columns == keyed.columns
    assert near.join(asked, "digest", "left_semi").count() == 40 and near.count() < 800
    pairs = asked.select(F.col("digest").alias("a")).withColumn("b", F.col("a"))
    found = near_dedup._texts(pairs, keyed, distinct)
    assert sorted(r.text for r in found.collect()) == sorted(f"text number {i}" for i in range(4000) if i % 200 < 2)
    assert near_dedup._likely(keyed, asked.limit(0)).count() == 0


def test_a_task_counts_one_range_of_shingles(spark):
    rng = random.Random(12)
    docs = spark.createDataFrame([(i, prose(rng, 300, "ab")) for i in range(40)] * 2, "doc_id long, text string")
    told = near_dedup.frequencies(near_dedup._dealt(near_dedup._keyed(docs), 3))
    held = told.groupBy(F.spark_partition_id()).agg(F.count_distinct("range").alias("n"))
    assert {r.n for r in held.collect()} == {1}


def test_samples_agree_as_often_as_sets_overlap():
    import numpy as np

    from tidemark.llm.arrays import mix

    rng = np.random.default_rng(0)
    agree = []
    for _ in range(60):
        h = np.sort(mix(rng.integers(0, 2**62, 300).astype(np.uint64)))
        light, heavy = np.full(300, 1.0), np.full(300, 2.0)
        both = near_dedup.samples(np.concatenate([h, h]), np.concatenate([light, heavy]), np.array([0, 300, 600]))
        agree.append((both[0] == both[1]).mean())
    assert abs(np.mean(agree) - 0.5) < 0.04  # weights 1 and 2 everywhere: similarity one half


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in range(200, 203)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_digest(spark, tmp_path):
    docs, texts = passages(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in substrings.op7(spark, str(tmp_path)).collect()}
    for i, (n, gone, kept) in enumerate(brute_passages(texts, 35)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    assert docs.where(F.col("text").isNull()).count() == 1


def sent(parts, range_=0):
    """A batch as buckets send it: each part a dictionary from shingle to count."""
    rows = [(i, range_, np.array(sorted(p), np.uint64).tobytes(), near_dedup.pack_counts(np.array([p[h] for h in sorted(p)]))) for i, p in enumerate(parts)]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["bucket", "range", "shingles", "n"])


def answered(batches):
    out = {}
    for batch in near_dedup._repeated(True)(iter(batches)):
        for r in batch.to_pylist():
            places = np.frombuffer(r["at"], "<u4")
            told = zip(places.tolist(), np.frombuffer(r["shingles"], np.uint64).tolist(), near_dedup.unpack_counts(r["n"], len(places)).tolist())
            assert out.setdefault((r["range"], r["bucket"]), list(told)) and len(places)
    return out


def test_a_range_is_summed_over_its_buckets():
    rng = random.Random(4)
    top = (1 << 64) - 1
    parts = [{h: rng.choice([1, 1, 1, 2, 254, 255, 256, 70_000]) for h in rng.sample([0, 1, top, *range(10, 200)], rng.randint(1, 60))} for _ in range(9)]
    parts += [{7: 1}, {8: 255}]  # one that nobody else holds, once and often
    whole = Counter()
    for p in parts:
        whole.update(p)
    want = {i: [(k, h, whole[h]) for k, h in enumerate(sorted(p)) if whole[h] > 1] for i, p in enumerate(parts)}
    want = {i: x for i, x in want.items() if x}
    batch = sent(parts)
    assert answered([batch]) == {(0, i): x for i, x in want.items()}
    assert answered([batch.slice(0, 4), sent([{7: 1}], 3), batch.slice(4)]) == {(0, i): x for i, x in want.items()}
    assert answered([]) == answered([sent([{7: 1}])]) == {}


def test_a_range_takes_little_more_room_than_its_shingles():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 2_000)
    parts = [dict.fromkeys(np.r_[rng.integers(0, 1 << 63, 8_000), common].tolist(), 1) for _ in range(30)]
    batch = sent(parts)
    size = 8 * sum(map(len, parts))
    tracemalloc.start()
    rows = sum(x.num_rows for x in near_dedup._repeated(False)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(parts)
    assert peak < 2.5 * size


def test_small_tables_between_jobs_are_few_files(spark):
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string")
    scratch = Path(scratch_root(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    with settings(spark, {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        near_dedup.text_classes(near_dedup._keyed(docs))
    files = {folder.name.rpartition("-")[0]: len(list(folder.glob("*.parquet"))) for folder in set(scratch.iterdir()) - before}
    assert files.keys() >= {"dedup-copies", "dedup-pairs", "dedup-texts", "dedup-links", "dedup-classes", "edges"}
    # A file for each core at most, not one for each shuffle partition.
    assert max(files.values()) <= spark.sparkContext.defaultParallelism < 24
