"""Ordering primitives, acceptance, quotas, model maps and file readers on small fixtures."""

import gzip
import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plinth.catalog import REGISTRY, q_files
from plinth.operators import acceptance as AC
from plinth.operators import model_map as MM
from plinth.operators.ordering import Ordered, ranked
from plinth.plans import fill as FI
from plinth.plans import quotas as Q
from plinth.sources import files as S
from plinth.sources import logs as L


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows."""
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", rng.randrange(100), rng.choice([None, 1.0, 2.0])) for i in range(3000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, key string, t int, v double")


def test_ordered_equals_plain_windows(skewed):
    w = Window.partitionBy("key").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select(
        "id", F.row_number().over(w).cast("long").alias("rn"), F.sum("t").over(upto).alias("s"), F.max("t").over(upto).alias("m"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("p"),
    )
    split = Ordered(skewed, ["t", "id"], by=["key"], buckets=7).row_number("rn").running_sum("t", "s").running_max("t", "m").last_before("v", "p").done()
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.select("id", "rn", "s", "m", "p").collect()), key=str)


def test_ranked_without_keys(skewed):
    got = {r["id"]: r["rn"] for r in ranked(skewed, ["id"], buckets=5).collect()}
    assert got == {i: i + 1 for i in range(3000)}


@pytest.mark.parametrize("seed", range(4))
def test_first_wins_equals_sequential_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"a{rng.randrange(12)}", f"b{rng.randrange(12)}", f"c{rng.randrange(20)}") for i in range(120)]
    old = [(-1, f"a{rng.randrange(12)}", "none", "none")]
    taken = [set(), set(), set()]
    for _, *keys in old:
        for seen, k in zip(taken, keys):
            seen.add(k)
    expected = []
    for i, *keys in rows:
        if not any(k in seen for seen, k in zip(taken, keys)):
            expected.append(i)
            for seen, k in zip(taken, keys):
                seen.add(k)
    schema = "seq long, x string, y string, z string"
    got = AC.first_wins(spark.createDataFrame(rows, schema), ["x", "y", "z"], "seq", spark.createDataFrame(old, schema))
    assert sorted(r["seq"] for r in got.collect()) == expected


def test_golden_quotas(spark):
    got = {(r["category"], r["complexity"]): r["quota"] for r in Q.quotas(spark, 50_000).collect()}
    assert got["rigid", "simple"] == 6667 and got["rigid", "complex"] == 6666
    assert got["soft", "simple"] == got["soft", "complex"] == 5000
    assert got["bonded", "simple"] == 3334 and got["bonded", "complex"] == 3333
    assert got["noncontact", "simple"] == got["noncontact", "complex"] == 3333
    assert sum(got.values()) == 50_000


CASES = [
    (dict(anchor_offered=False), "anchor not offered"), (dict(anchor_reused=True), "anchor reused"),
    (dict(placed_offered=False), "placed not offered"), (dict(anchor_name=""), "bad anchor name"),
    (dict(anchor_name="a b c d"), "bad anchor name"), (dict(anchor_name="colorful bird"), "styled anchor name"),
    (dict(placed_description=" "), "empty description"), (dict(placement="mug on the shelf " + "x " * 12), "phrase too long"),
    (dict(placement="mug on shelf"), "anchor without article"), (dict(placement="on the shelf"), "placed object missing"),
    (dict(placement="mug stabbed into the shelf"), "forceful verb"), (dict(), None),
    (dict(placed_name="orange", placement="orange on the shelf"), None),
    (dict(placed_name="hockey stick", placement="hockey stick on the shelf"), None),
]


def test_scene_validator_reasons(spark):
    base = dict(anchor_name="shelf", placed_name="mug", anchor_description="a shelf", placed_description="a mug",
                placement="mug on the shelf", anchor_offered=True, anchor_reused=False, placed_offered=True)
    rows = [(n, *{**base, **change}.values()) for n, (change, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, ["n", *base])
    problem = AC.scene_problem(F.col("anchor_offered"), F.col("anchor_reused"), F.col("placed_offered"))
    got = {r["n"]: r["p"] for r in df.select("n", problem.alias("p")).collect()}
    assert [got[n] for n in range(len(CASES))] == [reason for _, reason in CASES]


def test_model_map_retries_and_pending(spark, tmp_path):
    def call(prompts):
        if any("boom" in p for p in prompts):
            raise RuntimeError("refused")
        return [None if p == "skip" else json.dumps({"n": len(p)}) if p != "bad" else "no json" for p in prompts], 0.5

    df = spark.createDataFrame([(1, "abc"), (2, "skip"), (3, "bad"), (4, "boom")], "id long, p string").coalesce(1)
    replies = MM.parsed(MM.model_map(df, "id", "p", call, batch=1, attempts=2), "n long")
    got = {r["id"]: r for r in replies.collect()}
    assert got[1]["data"]["n"] == 3 and "refused" in got[4]["error"] and got[4]["calls"] == 0
    assert got[2]["data"] is None and got[3]["data"] is None
    done, pending = MM.split_done(replies)
    assert (done.count(), pending.count()) == (1, 3)
    assert MM.spend(replies).first()["cost"] == 1.5


def test_caption_csv_rules(spark, tmp_path):
    uid = ["%032x" % n for n in range(9)]
    body = "sha,identifier,aesthetic,captions\r\n" + "\r\n".join([
        f'a,https://h/{uid[0]},5.12345,"[""a, b"", ""c""]"', f'a,https://h/{uid[1]}/,6,"[""say """"hi"""" "", ""x\ny""]"'.replace('""""', '\\""'),
        f"a,https://h/{uid[2]},6", f'a,https://h/{uid[3]},6,"[]"', f"a,https://h/{uid[4]},6,null", f"a,https://h/{uid[5]},6,oops",
        f'a,https://h/{uid[6]},6,"[""not in paths""]"', 'a,https://h/short,6,"[""no uid""]"',
    ]) + "\r\n"
    (tmp_path / "c.csv").write_text(body, newline="")
    paths = spark.createDataFrame([(u, f"glb/{u}") for u in uid[:6]], "uid string, glb string")
    got = {r["uid"]: r for r in S.caption_assets(S.caption_csv(spark, str(tmp_path / "c.csv")), paths).collect()}
    assert uid[0] in got and set(got) <= {uid[0], uid[1]}
    assert got[uid[0]]["aesthetic"] == 5.123 and got[uid[0]]["caption"] == "a, b" and got[uid[0]]["short"] == "c"


def test_dictionary_lines_and_corpus(spark, tmp_path):
    with gzip.open(tmp_path / "000.json.gz", "wt") as f:
        json.dump({"u1": {"name": "n", "license": "by", "x": 1}, "u2": {"name": "m"}}, f)
    got = {r["uid"]: (r["name"], r["license"]) for r in S.annotation_shards(spark, str(tmp_path / "*.json.gz")).collect()}
    assert got == {"u1": ("n", "by"), "u2": ("m", None)}
    (tmp_path / "pool.jsonl").write_text('{"uid": "a"}\n{"uid": "b"}\n{"uid": "c')
    assert sorted(r["uid"] for r in S.json_lines(spark, str(tmp_path / "pool.jsonl"), "uid string").collect()) == ["a", "b"]
    root = tmp_path / "generated"
    for name, text in (("one", '{"id": "one"}'), ("two", '{"id": '), ("three", None)):
        (root / name).mkdir(parents=True)
        if text:
            (root / name / "metadata.json").write_text(text)
    (root / "one" / "mug_1.PNG").write_bytes(b"x")
    (root / "one" / "b.glb").write_bytes(b"x")
    (root / "one" / "one.glb").write_bytes(b"x")
    found = {r["folder"]: r["broken"] for r in S.corpus(spark, str(root), "id string").collect()}
    assert found == {"one": False, "two": True}
    with pytest.raises(Exception, match="two/metadata.json"):
        S.corpus_strict(spark, str(root), "id string").collect()
    files = S.listing(spark, str(root))
    assert [(r["stem"], r["image"]) for r in S.images_by_stem(files).collect()] == [("mug_1", "mug_1.PNG")]
    assert S.mesh_listing(files).first()["meshes"] == ["b.glb", "one.glb"]
    assert S.run_meshes(files).first()["meshes"] == ["one.glb", "b.glb"]


def test_landed_files_read_like_folders(spark, tmp_path):
    root, out = tmp_path / "generated", str(tmp_path / "landed")
    for name, text in (("one", '{"id": "one"}'), ("two", '{"id": '), ("three", "")):
        (root / name).mkdir(parents=True)
        (root / name / "metadata.json").write_text(text)
    S.land(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root)), out)
    files = S.landed(spark, out)
    plain = lambda df: sorted(map(tuple, df.drop("file").collect()), key=str)
    assert plain(S.landed_corpus(files, "id string")) == plain(S.corpus(spark, str(root), "id string"))
    assert plain(S.listed(files)) == plain(S.listing(spark, str(root)))


def test_samples_are_not_written_as_a_file_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_files, "scratch", lambda spark, label: str(tmp_path / "out" / label))
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    assert REGISTRY["s10_sample_listing"].run(spark, str(tmp_path)).where("files = 1").select("folder").distinct().count() == 3000
    assert len(list((tmp_path / "out").rglob("*"))) < 300


def test_fill_goes_on_while_rounds_bring_scenes(spark):
    rows = [(f"{i:032d}", "a thing", "by", False, ["rigid"], ["rigid"]) for i in range(12)]
    pool = spark.createDataFrame(rows, "uid string, caption string, license string, junk boolean, anchor array<string>, placed array<string>")

    def one_a_call(prompts):
        found = []
        for p in prompts:
            a, b = ([line[2:34] for line in block.split("\n")[1:]] for block in p.split("\n\n")[2:4])
            relation = p.split("\n\n")[1].split("\n")[1].split(". ", 1)[1].split(" — ")[0]
            scene = {"anchor_uid": a[0], "anchor_name": f"stand {a[0][-2:]}", "anchor_description": "x", "placed_uid": b[0],
                     "placed_name": f"item {b[0][-2:]}", "placed_description": "x"}
            scene["placement"] = f"{scene['placed_name']} {relation} the {scene['anchor_name']}"
            found.append(json.dumps({"samples": [scene]}))
        return found, 0.0

    got = FI.fill_report(pool, 20, ["desk"], one_a_call, "s", rounds=1)
    assert sorted((r["complexity"], r["count"]) for r in got.scenes.groupBy("complexity").count().collect()) == [("complex", 2), ("simple", 3)]


def test_log_with_broken_transforms_keeps_sections(spark, tmp_path):
    (tmp_path / "2024-01-01T00-00-00-000Z_mug_1.md").write_text(
        "# mug_1\n\n- at: 2024-01-01T00:00:00.000Z\n- model: m\n- cost: $0.01\n\n## Placement\n\n\"on it\"\n\n## User prompt\n\n```\nhi\nyou\n```\n\n"
        "## Resolved transforms (baked)\n\n```json\n{oops\n```\n")
    row = L.parse_logs(L.log_files(spark, str(tmp_path))).first()
    assert (row["stamp"], row["sample_id"]) == ("2024-01-01T00-00-00-000Z", "mug_1")
    assert (row["model"], row["cost"], row["placement"], row["user"], row["transforms"]) == ("m", "$0.01", "on it", "hi\nyou", None)


def test_ranges_over_text_and_zoned_times(spark):
    names = sorted(f"{q}{n:03d}" for n in range(150) for q in ("'", "\\", "a"))
    df = spark.createDataFrame([(n,) for n in names], "name string").withColumn(
        "at", F.timestamp_seconds(F.abs(F.xxhash64("name")) % 1_000_000))
    assert [r["name"] for r in ranked(df, ["name"], buckets=9).orderBy("rn").collect()] == names
    times = [r["at"] for r in ranked(df, ["at", "name"], buckets=9).orderBy("rn").collect()]
    assert times == sorted(times)
