import random

import pytest
from pyspark.sql import functions as F

from revlens.llm import decontamination as dec

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def slow_ends(item, text):
    """Edit distance of item against the best substring that ends at each place of text."""
    row = list(range(len(item) + 1))
    out = [row[-1]]
    for c in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
        out.append(row[-1])
    return out


def slow_best(item, text):
    """Least edit distance of item against any substring of text, and its first end."""
    ends = slow_ends(item, text)
    return min(ends), ends.index(min(ends))


def slow_occurrences(item, text, k):
    """Spans by distance, then end, each the shortest at its distance, none overlapping."""
    taken = []
    for d, end in sorted((d, e) for e, d in enumerate(slow_ends(item, text)) if d <= k):
        # the distance of the whole item to text[start:end], for the latest start that has it
        start = next(s for s in range(end, -1, -1) if slow_whole(item, text[s:end]) == d)
        if start < end and all(end <= a or start >= b for a, b, _ in taken):
            taken.append((start, end, d))
    return sorted(taken)


def slow_whole(a, b):
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        last, row[0] = row[0], j
        for i, p in enumerate(a, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
    return row[-1]


def edit(rng, text, k):
    for _ in range(k):
        at = rng.randrange(len(text) or 1)
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + "q" + text[at:], text[:at] + "q" + text[at + 1:]])
    return text


def test_myers_matches_the_full_table():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 60))) + rng.choice([edit(rng, item, rng.randint(0, 4)), ""])
        ends = slow_ends(item, text)
        for k in (0, 3, 10):
            assert dec.myers(item, text, k) == [(d, j) for j, d in enumerate(ends) if d <= k]


def test_every_occurrence_matches_brute_force():
    rng = random.Random(4)
    for n in range(40):
        item = "".join(rng.choices("ab" if n % 2 else "abcdefgh", k=rng.randint(8, 24)))
        text = "".join(edit(rng, item, rng.randint(0, 2)) + "xyz"[:rng.randint(0, 3)] for _ in range(rng.randint(1, 4)))
        for k in (1, 2):
            assert dec.occurrences(item, text, k) == slow_occurrences(item, text, k), (item, text, k)
    assert dec.joined([(100, 110), (5, 20), (0, 10), (20, 25)]) == [(0, 25), (100, 110)]


@pytest.mark.parametrize("block", [10**6, 200])
def test_back_to_back_items_are_all_found(spark, words, block):
    item = " ".join(words[:20])
    near = item[:40] + "#" + item[41:]
    texts = [item + item, f"{item} {item} {item}", f"{near} {item}\n{near}", item + " " + " ".join(words[50:90]) + " " + item]
    other = " ".join(words[100:125])
    docs = spark.createDataFrame(list(enumerate(texts)) + [(9, None)], DOCS).withColumn("_row", F.lit("kept"))
    got = {r.doc_id: r for r in dec.find_items(docs, spark.createDataFrame([(1, item), (2, other)], ITEMS), block_chars=block).collect()}
    assert [len(got[d].matches) for d in (0, 1, 2, 3, 9)] == [2, 3, 3, 2, 0] and all(r["_row"] == "kept" for r in got.values())
    for d, text in enumerate(texts):
        for m in got[d].matches:
            assert slow_whole(item, dec.normalise(text)[m.start:m.end]) == m.distance <= 1
    assert [m.distance for m in got[2].matches] == [1, 0, 1]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(2)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]


def test_items_within_the_budget_are_found(spark, words):
    rng = random.Random(3)
    items = [" ".join(rng.choices(words, k=rng.randint(15, 50))) for _ in range(12)] + ["İtem ÉÀ " + " ".join(words[:20])]
    rows, planted = [], {}
    for d in range(150):
        text = " ".join(rng.choices(words, k=rng.randint(0, 120)))
        if d % 3 == 0:
            i = rng.randrange(len(items))
            k = rng.randint(0, dec.budget(len(items[i])))
            part = edit(rng, items[i], k)
            part = part.upper() if d % 2 and i < 12 else part.replace(" ", "\n") if d % 5 == 0 else part
            text = f"{text} {part} {' '.join(rng.choices(words, k=20))}"
            planted[d] = i
        rows.append((d, text))
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(list(enumerate(items)), ITEMS)
    for size in (10**6, 300):  # one block, and a block for every item or two
        got = {r.doc_id: r.matches for r in dec.find_items(docs, bench, block_chars=size).collect()}
        for d, text in rows:
            low = dec.normalise(text)
            want = {i for i, item in enumerate(items) if slow_best(dec.normalise(item), low)[0] <= dec.budget(len(item))}
            assert {m.item_id for m in got[d]} == want
            assert d not in planted or planted[d] in want
            for m in got[d]:  # the span holds the item at the distance given
                assert 0 <= m.start <= m.end <= len(text)
                item = dec.normalise(items[m.item_id])
                assert slow_best(item, low[m.start:m.end]) == (m.distance, m.end - m.start)
    kept = {r.doc_id for r in dec.drop_contaminated(docs, bench).collect()}
    assert kept == {d for d, m in got.items() if not m} and not kept & planted.keys()


def test_defined_cases(spark, words):
    item = " ".join(words[:20])
    docs = spark.createDataFrame([(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "a short one"), (5, "a shorty one"),
                                  (6, "pad " * 60_000 + item), (7, f"{item} and {item}")], DOCS)
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "  "), (5, "short"), (None, item[:60])], ITEMS)
    got = [(r.doc_id, sorted({str(m.item_id) for m in r.matches}), len(r.matches)) for r in dec.find_items(docs, bench).collect()]
    by = {d: (ids, n) for d, ids, n in got}
    assert len(got) == 9 and by[1] == by[2] == ([], 0) and by[3] == (["1", "None"], 3) == by[None]
    assert by[4] == (["5"], 1) and by[5] == ([], 0) and by[6] == (["1", "None"], 3)
    assert by[7] == (["1", "None"], 6)  # both occurrences of each of the three


def test_empty_tables_and_names(spark):
    docs, none = spark.createDataFrame([(1, "x")], DOCS), spark.createDataFrame([], ITEMS)
    assert dec.find_items(docs, none).first().matches == []
    bench = spark.createDataFrame([(1, "y" * 50)], ITEMS)
    assert dec.find_items(spark.createDataFrame([], DOCS), bench).count() == 0
    named = docs.withColumn("_hits", F.lit(1)).withColumn("matches", F.lit(2)).withColumn("a.b", F.lit(3))
    assert dec.drop_contaminated(named, bench).columns == named.columns
