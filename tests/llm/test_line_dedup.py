import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import line_dedup

SCHEMA = "doc_id long, source string, text string"


def bound(n, total):
    z, p = line_dedup.CONFIDENCE_Z, n / total
    return (p + z * z / (2 * total) - z * (p * (1 - p) / total + z * z / (4 * total * total)) ** 0.5) / (1 + z * z / total)


def over(n, total, ratio=line_dedup.BOILERPLATE_RATIO):
    return n >= 2 and bound(n, total) > ratio


def boilerplate(pages, ratio=line_dedup.BOILERPLATE_RATIO):
    """(host, line) over the ratio; ``pages`` are (host, content, text), equal contents are one page."""
    total, count = defaultdict(set), defaultdict(lambda: defaultdict(set))
    for host, content, text in pages:
        total[host].add(content)
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            count[host][line].add(content)
    return {(h, x) for h, c in count.items() for x, n in c.items() if over(len(n), len(total[h]), ratio)}


def near_labels(pages, key):
    """The page that each (host, text) counts as; ``key`` orders the lines as their hashes do."""
    count = defaultdict(Counter)
    for host, text in set(pages):
        count[host].update({x.strip(" ") for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in pages:
        lines = {x.strip(" ") for x in (text or "").split("\n")} - {""}
        repeated = [x for x in lines if count[host][x] > 1]
        near = repeated and sum(map(len, repeated)) >= line_dedup.NEAR_SHARE * sum(map(len, lines))
        out.append(("near", min(key[x] for x in repeated)) if near else text)
    return out


def line_hashes(spark, texts):
    lines = {(x.strip(" "),) for t in texts for x in (t or "").split("\n")}
    return dict(map(tuple, spark.createDataFrame(lines, "x string").select("x", F.xxhash64("x")).collect()))


def expected(rows, ratio):
    gone = boilerplate([(host, text, text) for _, host, text in rows], ratio)
    out = []
    for d, host, text in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if (host, x.strip(" ")) not in gone]
        out.append((d, "\n".join(kept), len(lines) if text else 0, len(lines) - len(kept)))
    return sorted(out, key=str)


def check(spark, rows, ratio=0.3):
    got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA), "source", ratio=ratio)
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=str) == expected(rows, ratio)


def test_one_rule_for_hosts_of_every_size(spark):
    rows, want, n = [], {}, 0
    for size, shares in ((1, [1]), (2, [1, 2]), (3, [1, 2, 3]), (9, [1, 2, 3, 9]), (20, [2, 3, 4, 20]),
                         (50, [2, 7, 8, 9]), (124, [10, 15, 22]), (1000, [80, 95, 97, 180])):
        for i in range(size):
            lines = [f"on {k}" for k in shares if i < k]
            rows.append((n, f"h{size}", "\n".join([f"own {size} {i}", *lines])))
            n += 1
        want |= {(f"h{size}", f"on {k}"): over(k, size) for k in shares}
    found = line_dedup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA), "source").collect()
    kept = {(r.source, x) for r in found for x in r.text.split("\n")}
    assert {k: k not in kept for k in want} == want
    assert want["h9", "on 9"] and want["h50", "on 9"] and want["h124", "on 22"] and not want["h1", "on 1"]
    assert not want["h20", "on 3"] and not want["h1000", "on 80"] and want["h1000", "on 97"]


def test_copies_are_one_page(spark):
    rows = [(i, "a", f"own {i}\nmore {i}") for i in range(40)] + [(100 + i, "a", "a copy\nof two lines") for i in range(20)]
    check(spark, rows, ratio=0.08)
    got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA), "source").collect()
    assert {r.doc_id: r.text for r in got} == {r[0]: r[2] for r in rows}


def test_lines_over_the_ratio_go(spark):
    rows = [(i, "a", f"menu\nown {i}\n  menu \n\nfoot") for i in range(6)]
    rows += [(10 + i, "b", f"menu\nown {i}" if i < 1 else f"own {i}") for i in range(6)]
    rows += [(20, None, "x\nmenu"), (21, None, "x\ny"), (22, "a", None), (23, "a", ""), (24, "a", "foot"),
             (24, "a", "foot"), (25, "c", "menu"), (26, "a", "menu\nmenu\nmenu"), (27, "a", "\n\n"), (28, "a", "word " * 40_000)]
    check(spark, rows)
    check(spark, rows, ratio=0.6)


def test_empty_and_extra_columns(spark):
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], SCHEMA), "source").count() == 0
    df = spark.createDataFrame([(1, "a", "x\ny")], SCHEMA).withColumn("_keys", F.lit(1)).withColumn("n_lines", F.lit(7))
    out = line_dedup.drop_boilerplate(df.withColumn("a.b", F.lit(2)), "source", counts=False)
    assert out.columns == ["doc_id", "source", "text", "_keys", "n_lines", "a.b"] and out.first().n_lines == 7


def test_pipeline_keeps_a_large_group_of_copies(spark):
    """Of exact and of near copies: each class is one page, so its text is there for the stage that keeps one."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghilmnorstu", k=7)) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(words, k=n))
    near = [line(60) for _ in range(8)]
    texts = [f"menu and more\n{line(40)}\n{line(30)}" if i % 2 else line(50) for i in range(60)]
    texts += ["a clean page\nof two lines"] * 30 + ["\n".join([*near, f"visit {i % 3}"]) for i in range(30)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    rows += [(200, None, "en", None, None), (201, None, "en", "a", None), (202, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.line_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {r[0]: r[1] and r[1].removeprefix("menu and more\n") for r in rows}
