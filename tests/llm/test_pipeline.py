"""Each stage against brute force on its own input, on a small corpus with planted cases."""
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from revlens.llm import decontamination
from tests.llm.test_line_dedup import boilerplate, line_hashes, near_labels
from tests.llm.test_simhash import slow_components, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghilmnorstu", k=rng.randint(2, 9))) for _ in range(900)]
    items = [" ".join(rng.choices(words, k=30)) for _ in range(5)]
    rows, labels = [], []
    for i in range(500):
        text = "\n".join(" ".join(rng.choices(words, k=rng.randint(10, 40))).capitalize() + "." for _ in range(rng.randint(2, 6)))
        good = True
        if i % 7 == 0:
            text, good = " ".join([rng.choice(words)] * 50), False
        elif i % 5 == 0:
            text = "All rights kept here.\n" + text
        elif i % 11 == 0:
            text += "\n" + rng.choice(items)
        elif i % 13 == 0 and rows:
            text = next(r[1] for r in reversed(rows) if r[0] % 7)  # an exact copy
        rows.append((i, text, "en", "src0" if i % 3 else "src1", len(text)))
        labels.append((i, int(good), 0))
    rows += [(900, None, None, None, None), (901, "", "en", "src0", 0), (3, rows[3][1], "en", "src0", 1)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def key(rows):
    return sorted([(r.doc_id, r.text) for r in rows], key=str)


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("_row", F.lit(1))
    stages = dict(C.STAGES)
    assert [n for n, _ in C.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]

    def step(name, docs):
        out = stages[name](spark, docs, path).cache()
        assert out.columns == [*COLUMNS, "_row"]
        return out, out.collect()

    good, rows = step("quality classifier", docs)
    kept = {r.doc_id for r in rows}
    assert len({i for i in range(500) if i % 7 == 0} & kept) <= 2 and len({i for i in range(500) if i % 7} - kept) <= 2

    clean, after = step("line dedup", good)
    page = near_labels([(r.source, r.text) for r in rows], line_hashes(spark, [r.text for r in rows]))
    gone = boilerplate([(r.source, c, r.text) for r, c in zip(rows, page)])
    assert any(x == "All rights kept here." for _, x in gone)
    want = [(r.doc_id, None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in gone)) for r in rows]
    assert key(after) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)

    single, rest = step("SimHash near-dedup", clean)
    label = slow_components([slow_fingerprint(r.text) for r in after])
    least = {}
    for r, c in zip(after, label):
        least[c] = min(least.get(c, (r.doc_id, r.text)), (r.doc_id, r.text), key=lambda x: x[0])
    assert sorted(r.doc_id for r in rest) == sorted(d for d, _ in least.values())

    pure, last = step("benchmark decontamination", single)
    held = {r.doc_id for r in rest if any(decontamination.normalise(i) in decontamination.normalise(r.text or "") for i in items)}
    assert held and {r.doc_id for r in last} == {r.doc_id for r in rest} - held

    packed = stages["packing"](spark, pure, path).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in last}
    by = {}
    for r in packed:
        by.setdefault(r.doc_id, []).append(r)
    assert all(sum(r.length for r in g) == g[0].doc_tokens for g in by.values())


def test_run_and_empty_table(spark, folder, tmp_path):
    path, _ = folder
    out = C.run(spark, path)
    assert out.count() > 0 and zlib.crc32(b"") == 0
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
