"""E1 ingest (batch and streaming), CSV interchange, category look-up, exports."""

import os

import pytest

from revlens.plans.ingest import ingest_dumps, parse_dumps
from revlens.sources import export, files
from revlens.streaming.ingest import start_ingest
from tests.test_raw import REC_A, REC_B, _write

BAD = REC_B.replace("P200", "P300").replace("12.50", "12,50").replace("2.0", "two")


def test_ingest_counts_and_store(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw")
    _write(src, "Tools.txt", REC_A + "\n\n" + REC_B + "\n\n" + BAD + "\n")
    _write(src, "Garden.txt", REC_B.replace("P200", "G1") + "\n")
    out = os.path.join(tmp_dir, "store")
    counts = ingest_dumps(spark, src, out, csv_out=os.path.join(tmp_dir, "csv"))
    assert counts == {"records": 4, "bad_price": 1, "bad_rating": 1, "bad_review_time": 0}
    tools = files.read_review_table(spark, out, "Tools", categories=["Tools", "Garden"])
    assert tools.count() == 3
    assert tools.filter("review_id is null").count() == 0
    with pytest.raises(ValueError):
        files.read_review_table(spark, out, "Toys", categories=["Tools", "Garden"])
    # a missing table is an empty one
    assert files.read_review_table(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_csv_quotes_and_commas(spark, tmp_dir):
    rows = [("p1", 'Ruler "Pro", 30 cm', 1.5, "u1", 'Jo, "J"', "1/1", 4.0, 10, "a,b", 'say "hi", ok')]
    df = spark.createDataFrame(rows, files.REVIEW_SCHEMA)
    files.write_csv(df, tmp_dir + "/c")
    back = files.read_csv_reviews(spark, tmp_dir + "/c").collect()
    assert [tuple(r) for r in back] == rows


def test_sample_is_repeatable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as review_id")
    a = [r.review_id for r in export.sample(df.repartition(4), 50).collect()]
    b = [r.review_id for r in export.sample(df.repartition(9), 50).collect()]
    assert a == b and len(a) == 50
    import hashlib

    order = sorted(map(str, range(1000)), key=lambda x: (hashlib.md5(x.encode()).hexdigest(), x))
    assert a == order[:50]
    assert [r.review_id for r in export.sample(df, 5000).collect()] == order
    assert export.sample(df.limit(0), 5).count() == 0


def test_streaming_ingest(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write(src, "Tools.txt", REC_A + "\n\n" + REC_B + "\n")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = start_ingest(spark, src, out, ck)
    q.awaitTermination(120)
    assert files.read_review_table(spark, out).count() == 2
    # a new file is picked up by the next run; the old one is not read twice
    _write(src, "Garden.txt", REC_B.replace("P200", "G1") + "\n")
    q = start_ingest(spark, src, out, ck)
    q.awaitTermination(120)
    stored = files.read_review_table(spark, out)
    assert stored.count() == 3
    assert sorted(r.category for r in stored.select("category").distinct().collect()) == ["Garden", "Tools"]


def test_batch_and_stream_share_a_store(spark, tmp_dir):
    """Batch, stream, restart, batch: no row is lost or doubled."""
    old, new, late = (os.path.join(tmp_dir, d) for d in ("old", "new", "late"))
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    _write(old, "My Tools+.txt", REC_A + "\n\n" + REC_B + "\n")
    ingest_dumps(spark, old, out)
    _write(new, "Garden.txt", REC_B.replace("P200", "G1") + "\n")
    for _ in range(2):
        start_ingest(spark, new, out, ck).awaitTermination(120)
    count = lambda: {r.category: r["count"] for r in files.read_review_table(spark, out).groupBy("category").count().collect()}
    assert count() == {"My Tools+": 2, "Garden": 1}  # file names are decoded
    _write(late, "Garden.txt", REC_A.replace("P100", "G2") + "\n")
    files.write_review_table(parse_dumps(spark, late), out, mode="append")
    assert count() == {"My Tools+": 2, "Garden": 2}
    assert files.read_review_table(spark, out, "Garden").count() == 2


def test_csv_keeps_blanks(spark, tmp_dir):
    rows = [(" p1", "t ", 1.5, "u1", "Bob ", "1/1", 4.0, 10, " a", " ")]
    df = spark.createDataFrame(rows, files.REVIEW_SCHEMA)
    files.write_csv(df, tmp_dir + "/c")
    assert [tuple(r) for r in files.read_csv_reviews(spark, tmp_dir + "/c").collect()] == rows


def test_same_review_in_two_categories_has_two_keys(spark, tmp_dir):
    for name in ("A.txt", "B.txt"):
        _write(tmp_dir, name, REC_A + "\n")
    ids = [r.review_id for r in parse_dumps(spark, tmp_dir).collect()]
    assert len(ids) == len(set(ids)) == 2


def test_exports_write_every_row(spark, tmp_dir):
    from revlens.operators import products, users
    from revlens.plans.tables import clean_table
    from tests.conftest import SF001

    clean = clean_table(spark, SF001)
    uid = clean.select("user_id").orderBy("user_id").first().user_id
    pid = clean.select("product_id").orderBy("product_id").first().product_id
    export.export_user_history(users.user_history(clean), uid, tmp_dir + "/s9")
    export.export_product_reviews(products.product_reviews(clean), pid, tmp_dir + "/s11")
    export.export_period(clean.drop("review_id"), tmp_dir + "/s14")
    recs = spark.createDataFrame([("u", "p", 4.5)], "user_id string, product_id string, predicted_rating double")
    export.export_recommendations(recs, tmp_dir + "/s10", with_score=False)
    read = lambda p: spark.read.option("header", True).csv(p)
    assert read(tmp_dir + "/s9").count() == clean.filter(clean.user_id == uid).count()
    assert read(tmp_dir + "/s11").count() == clean.filter(clean.product_id == pid).count()
    assert read(tmp_dir + "/s14").count() == clean.count()
    assert read(tmp_dir + "/s10").columns == ["user_id", "product_id"]


def test_ingest_command(tmp_dir):
    import json
    import subprocess
    import sys

    src = os.path.join(tmp_dir, "raw")
    _write(src, "Tools.txt", REC_A + "\n\n" + BAD + "\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "revlens.plans.ingest", src, os.path.join(tmp_dir, "store")],
        cwd=repo, capture_output=True, text=True, timeout=300,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    counts = json.loads(out.stdout.strip().splitlines()[-1])
    assert counts == {"records": 2, "bad_price": 1, "bad_rating": 1, "bad_review_time": 0}
