"""Personal data: seeds against plain patterns, discovered spans against a brute-force bootstrap, defined cases."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from revlens.llm import pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain_seeds(text):
    found = [(m.start(), k, m.end(), name) for k, (name, form) in enumerate(FORMS.items())
             for m in re.finditer(form, text or "") if passes(name, m.group())]
    return [(s, e, name) for s, _, e, name in sorted(found)]


def plain_bootstrap(texts, rounds=pii.ROUNDS):
    """Added spans per text, by dictionaries."""
    places, links, known = [], defaultdict(set), defaultdict(dict)
    for n, text in enumerate(texts):
        base = plain_seeds(text)
        for s, e, kind in base + [(*c, None) for c in pii.candidates(text or "", base)]:
            instance, pattern = " ".join(text[s:e].lower().split()), pii.context(text, s)
            links[pattern].add(instance)
            if kind:
                known[instance][kind] = 1.0
            else:
                places.append((n, s, e, instance))
    found = {}
    evidence = {p: len(i) / (len(i) + pii.EVIDENCE) for p, i in links.items()}
    for _ in range(rounds):
        members = {i: set(k) for i, k in known.items()} | {i: {k} for i, k in found.items()}
        sums = defaultdict(lambda: defaultdict(float))
        for pattern, instances in links.items():
            for kind in pii.KINDS:
                support = sum(kind in members.get(i, ()) for i in instances)
                confidence = support / (len(instances) + pii.DOUBT)
                if support >= pii.MIN_SUPPORT and confidence >= pii.PATTERN_CONFIDENCE:
                    for i in instances:
                        sums[i][kind] += confidence * evidence[pattern]
        found = {}
        for i, kinds in sums.items():
            weight = sum(evidence[p] for p, instances in links.items() if i in instances)
            x, _, kind = max((round(v / weight, 9), -pii.KINDS.index(k), k) for k, v in kinds.items())
            if i not in known and x >= pii.INSTANCE_CONFIDENCE:
                found[i] = kind
    added = defaultdict(list)
    for n, s, e, i in places:
        if i in found:
            added[n].append((s, e, "found_" + found[i]))
    return added


def planted():
    rnd = random.Random(5)
    words = "the of thing ever shall many some with ring".split()
    fill = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    texts = [f"{fill(20)} reach me: user{i}@mail{i}.example.com {fill(5)}" for i in range(60)]
    texts += [f"{fill(9)} call us +1 (555) 010-{1000 + i} now" for i in range(9)]
    texts += [f"{fill(9)} call us 555 010 2345 now"]
    for i in range(6):
        texts += [f"{fill(9)} reach me: bob{i}@localhost. {fill(3)}", f"{fill(5)} home box bob{i}@localhost {fill(4)}"]
    texts += [f"{fill(5)} home box ann@localhost {fill(4)}"]  # reached over the discovered ones
    texts += [f"{fill(8)} year {y} {fill(3)}" for y in range(1990, 2020)] + [f"{fill(8)} call us 1995 {fill(3)}"] * 3
    return texts + [texts[0], texts[70], None, "", "a" * 3_000, "1" * 3_000, "x@" * 900, "1.2.3.4.5.6.7.8 256.1.1.1"]


def run(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = pii.find_personal_data(docs).select("doc_id", pii.listed(F.col("base")).alias("b"),
                                               pii.listed(F.col("spans")).alias("s")).collect()
    return {r.doc_id: (r.b, r.s) for r in rows}


def text_of(spans):
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def test_equals_brute_force(spark):
    texts = planted()
    got, added = run(spark, texts), plain_bootstrap(texts)
    kinds = [*pii.KINDS, *pii.FOUND]
    for n, text in enumerate(texts):
        base = plain_seeds(text)
        every = sorted(base + added[n], key=lambda x: (x[0], kinds.index(x[2])))
        assert got[n] == (text_of(base), text_of(every)), text
    shown = {texts[n][s:e] for n, spans in added.items() for s, e, _ in spans}
    assert shown == {"ann@localhost", *[f"bob{i}@localhost" for i in range(6)], "555 010 2345"}


@pytest.mark.parametrize("seed", range(3))
def test_seeds_equal_the_plain_patterns(seed):
    rnd = random.Random(seed)
    pieces = ["a.b@", "@", "c.d", "@e-f.g.h", ".", "..", "1.2.3.4", "255", "256", " ", "-", "\n", "4111 1111 1111 1111",
              "378282246310005", "+1 (2", "+49 30 123456", ") 555-1234", "é", "0", "9", "x_y%z", "++1", "1-", "(", "007.1.1.1"]
    for _ in range(2000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 14)))
        assert pii.seeds(text) == plain_seeds(text), text


def test_candidates_overlap_no_seed_and_are_trimmed():
    text = 'see "AB-1234", tel=5550123 and me@host (4111 1111 1111 1111) or 12 555 0101 2223'
    base = pii.seeds(text)
    assert [text[s:e] for s, e in pii.candidates(text, base)] == ["AB-1234", "5550123", "me@host", "12 555 0101 2223"]
    assert pii.context(text, text.index("5550123")) == "ab-0000 tel="
    assert pii.context("x\n42", 2) == "^ ^"


def test_null_ids_repeats_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (2, None)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "found", "base", "spans", "instance", "kind")})
    got = pii.find_personal_data(docs).select("doc_id", pii.listed(F.col("spans"))).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "email:0:5"), (1, "email:0:5"), (2, ""), (None, "email:0:5")]
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_long_words_take_one_pass():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "x@" * 500_000, "1." * 500_000, "+1" * 500_000):
        pii.seeds(text)
        list(pii.candidates(text, []))
