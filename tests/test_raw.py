"""Raw review dumps -> typed rows, with the edge cases of the format."""

import os

import pytest
from pyspark.sql import functions as F

from revlens.operators.clean import clean_reviews
from revlens.sources import raw

REC_A = """product/productId: P100
product/title: Folding "Pro" Ruler, 30 cm
product/price: unknown
review/userId: U1
review/profileName: Jo "the maker" Smith
review/helpfulness: 1/2
review/score: 4.0
review/time: 1300000000
review/summary: Handy
review/text: Measures well &amp; folds flat."""

REC_B = """product/productId: P200
product/title: Brass Hinge
product/price: 12.50
review/userId: U2
review/profileName: Kim
review/helpfulness: 0/0
review/score: 2.0
review/time: 1200000000
review/summary: Bent
review/text: Arrived bent."""


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return p


def _rows(spark, path, **kw):
    return sorted(raw.read_raw_reviews(spark, path, **kw).collect(), key=lambda r: (r.product_id or "", r.user_id or ""))


def test_two_records_and_types(spark, tmp_dir):
    _write(tmp_dir, "Tools.txt", REC_A + "\n\n" + REC_B + "\n")
    rows = _rows(spark, tmp_dir)
    assert len(rows) == 2
    a, b = rows
    assert a.product_id == "P100" and a.price is None and a.rating == 4.0 and a.review_time == 1300000000
    assert a.user_name == "Jo the maker Smith"  # quotes removed
    assert a.title == 'Folding "Pro" Ruler, 30 cm'
    assert a.review_text == "Measures well &amp; folds flat."  # entities kept
    assert b.price == 12.5 and b.category == "Tools"
    # cleaning drops the unknown-price review
    assert clean_reviews(raw.read_raw_reviews(spark, tmp_dir)).count() == 1


def test_separators(spark, tmp_dir):
    text = "\n\n\n" + REC_A + "\n  \t\n\n\n" + REC_B  # leading blanks, whitespace-only line, no trailing blank
    _write(tmp_dir, "Tools.txt", text)
    assert len(_rows(spark, tmp_dir)) == 2


def test_crlf(spark, tmp_dir):
    text = (REC_A + "\n\n" + REC_B + "\n").replace("\n", "\r\n")
    _write(tmp_dir, "Tools.txt", text)
    rows = _rows(spark, tmp_dir, line_sep="\r\n\r\n")
    assert [r.product_id for r in rows] == ["P100", "P200"]
    assert rows[1].review_text == "Arrived bent."


def _parts(df):
    return df.select(F.spark_partition_id()).distinct().count()


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("blank", ["", " \t"])
def test_dumps_of_any_separator_are_read_by_several_tasks(spark, tmp_dir, end, blank):
    recs = [REC_A.replace("P100", f"P{i}") + "\n" + blank for i in range(400)]
    _write(tmp_dir, "Tools.txt", "\n".join(recs).replace("\n", end))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        blocks = raw.read_raw_blocks(spark, tmp_dir).filter(F.trim("block") != "")
        assert _parts(blocks) >= 4
        rows = raw.read_raw_reviews(spark, tmp_dir).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.product_id for r in rows) == sorted(f"P{i}" for i in range(400))
    assert {r.review_text for r in rows} == {"Measures well &amp; folds flat."}


def test_a_folder_of_several_separators(spark, tmp_dir):
    text = REC_A + "\n\n" + REC_B
    for n, end in enumerate(["\n", "\r\n", "\r", "\n"]):
        _write(f"{tmp_dir}/shop={n}", f"T{n}.txt", text.replace("\n", end))
    _write(f"{tmp_dir}/shop=9", "blank.txt", "")
    _write(tmp_dir, "_hidden.txt", text)
    found = raw.separators(spark, tmp_dir)
    assert {s: len(f) for s, f in found.items()} == {"\n\n": 2, "\r\n\r\n": 1, "\r\r": 1}
    got = sorted((r.category, r.shop, r.product_id) for r in raw.read_raw_reviews(spark, tmp_dir).collect())
    assert got == [(f"T{n}", n, p) for n in range(4) for p in ("P100", "P200")]
    for i in range(raw.MAX_SCANS + 3):  # more separators than scans: the rare ones are read with the default
        _write(f"{tmp_dir}/shop={20 + i}", f"W{i}.txt", text.replace("\n\n", "\n" + " " * (i + 1) + "\n"))
    assert raw.read_raw_reviews(spark, tmp_dir).count() == 2 * (4 + raw.MAX_SCANS + 3)


def test_separator_of_a_head():
    assert raw.separator_of(b"") == raw.separator_of(b"no break\nhere") == "\n\n"
    assert raw.separator_of(b"a\r\n\r\nb\r\n\r\nc\n\nd") == "\r\n\r\n"


def test_key_rules(spark, tmp_dir):
    rec = "\n".join([
        "   product/productId: P300   ",  # leading spaces before a key
        "product/colour: red",  # unknown key ignored
        "review/userId: U3",
        "review/userId: U4",  # duplicate key: last wins
        "review/summary: good review/summary: cut here",  # key repeated inside value
        "review/score: five",  # non-numeric score
        "product/price: 1,5",  # non-numeric price
    ])
    _write(tmp_dir, "Misc.txt", rec + "\n\nproduct/colour: only unknown keys\n")
    blocks = raw.read_raw_blocks(spark, tmp_dir)
    parsed = raw.parse_blocks(blocks, keep_raw=True)
    rows = parsed.collect()
    assert len(rows) == 1  # the block with only unknown keys is no record
    r = rows[0]
    assert r.product_id == "P300" and r.user_id == "U4" and r.review_summary == "good"
    assert r.rating is None and r.price is None and r.title is None  # missing key -> null
    rej = raw.count_rejects(parsed).first()
    assert (rej.records, rej.bad_price, rej.bad_rating, rej.bad_review_time) == (1, 1, 1, 0)


def test_round_trip(spark, tmp_dir):
    _write(tmp_dir, "Tools.txt", REC_A + "\n\n" + REC_B + "\n")
    first = raw.read_raw_reviews(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    raw.write_raw(first.drop("category"), out)
    again = raw.read_raw_reviews(spark, out, category="Tools")
    cols = [c for c in first.columns]
    assert sorted(map(tuple, first.select(cols).collect())) == sorted(map(tuple, again.select(cols).collect()))


# ---- property: render -> parse gives the rows back -------------------------------

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from revlens.schema import REVIEW_SCHEMA  # noqa: E402

_alphabet = st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp"), blacklist_characters="\n\r\x85")
_text = st.text(alphabet=_alphabet, max_size=25).map(lambda s: s.strip(raw._WS_CHARS)).filter(
    lambda s: all(k not in s for k in raw.RAW_KEYS.values()))
_row = st.tuples(
    _text.filter(bool), st.one_of(st.none(), _text), st.one_of(st.none(), st.floats(0, 1e4, width=32)),
    _text.filter(bool), st.one_of(st.none(), _text.map(lambda s: s.replace('"', ""))),
    st.one_of(st.none(), _text), st.one_of(st.none(), st.sampled_from([1.0, 2.0, 3.5, 5.0])),
    st.one_of(st.none(), st.integers(0, 2_000_000_000)), st.one_of(st.none(), _text), st.one_of(st.none(), _text),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(_row, min_size=1, max_size=15))
def test_render_parse_round_trip(spark, tmp_path_factory, rows):
    out = str(tmp_path_factory.mktemp("rt"))
    df = spark.createDataFrame(rows, REVIEW_SCHEMA)
    raw.write_raw(df, out)
    back = raw.read_raw_reviews(spark, out, category="c").drop("category")

    def norm(r):
        # an empty value is written as "key: " and read back as ""; null stays null
        return tuple(r)

    assert sorted(map(norm, back.collect()), key=repr) == sorted(map(norm, df.collect()), key=repr)


def test_dumps_of_the_raw_queries_are_compressed(spark, tmp_path):
    """As text they are several times the size of the table."""
    from revlens.plans.registry import _raw_dump
    from tests.conftest import SF001

    path = _raw_dump(spark, SF001)
    files = spark.read.text(path).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
