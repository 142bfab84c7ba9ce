import random
import re

import corpus_pipeline
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, make, words, messy, tmp_path):
    """Each stage on all that the one before kept, against what should happen to planted rows."""
    draw = random.Random(6)
    prose = lambda n: " ".join(draw.choices(words, k=n))
    items = [(k, prose(25)) for k in range(3)]
    rows = [(i, prose(draw.randint(40, 80)), "en", draw.choice("abc")) for i in range(120)]
    base = rows[7][1].split()
    near = [(200 + k, " ".join([*base[:k], "changed", *base[k + 1 :]]), "en", "a") for k in range(3)]
    leaks = [(300 + k, prose(30) + " " + text + " " + prose(30), "en", "b") for k, text in items]
    bad = [(400, "too short", "en", "a"), (401, " ".join(words[:9] * 12), "en", "b"), (402, None, "en", "c")]
    same = [rows[11], rows[11]]
    everything = rows + near + leaks + bad + same
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = make(everything)

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "sharding"]
    left, seen = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        left.write.parquet(str(tmp_path / f"stage{k}"))
        left = stage(spark, spark.read.parquet(str(tmp_path / f"stage{k}")), str(tmp_path))
        if k < 4:
            assert left.columns == docs.columns
            seen.append(sorted(r["doc_id"] for r in left.select("doc_id").collect()))
    ids = lambda some: sorted(r[0] for r in some)
    assert seen[0] == ids(rows + near + leaks + same)
    assert seen[1] == ids(rows + leaks)
    assert seen[2] == ids(rows)
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    total, taken = sum(size.values()), sum(size[i] for i in seen[3])
    assert abs(taken - total) < 0.02 * total
    placed = left.collect()
    assert sorted(r["doc_id"] for r in placed) == seen[3]
    for shard in {r["shard"] for r in placed}:
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_an_id_at_several_texts(spark, make, words):
    """Rows are told apart by all they hold; equal rows are one document."""
    prose = lambda k: " ".join(words[k : k + 40])
    rows = [(1, prose(0), "en", "a"), (2, prose(0), "en", "a"), (2, prose(100), "en", "a"), (2, prose(100), "en", "a")]
    rows += [(None, prose(200), "en", "a"), (9, prose(200), "en", "a"), (None, None, "en", "a"), (3, "", "en", "a")]
    left = corpus_pipeline.near_duplicates(spark, make(rows), "")
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr)
    assert got == sorted([(1, prose(0)), (2, prose(100)), (9, prose(200)), (None, None), (3, "")], key=repr)


def test_common_lines_are_cut(spark, make, words):
    own = lambda i: " ".join(f"{w}{i}" for w in words[:20])
    line = " ".join(words[50:80])
    left = corpus_pipeline.quality_rules(spark, make([(i, f"{own(i)}\n{line}", "en", "a") for i in range(40)]), "")
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert texts == {i: f"{own(i)}\n" + (line if i == 0 else "") for i in range(40)}


def test_odd_rows(spark, make, messy, tmp_path):
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (messy, []):
        docs = make(rows)
        for _, stage in corpus_pipeline.STAGES[1:4]:  # the rules alone would reject most of them
            docs = stage(spark, docs, str(tmp_path))
        assert corpus_pipeline.sharding(spark, docs, str(tmp_path)).count() >= 0
        corpus_pipeline.quality_rules(spark, make(rows), str(tmp_path)).collect()
