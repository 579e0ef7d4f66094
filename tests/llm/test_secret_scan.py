import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from revlens.llm import secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(5)
    bits = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", " ", "'", '"', "\n", "é", "😀", "AKIA",
            "ABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "abc", "x.y-z_", "ſecret", "K", "\t"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(400)]
    texts += ["token=secret: abcdefghijklmnop", "AKIA" + "A" * 13, "AKIA" + "A" * 14, "f" * 15, "f" * 16, "", None,
              "é" * 1000 + "token=" + "z" * 5000, "AKIAAKIAAKIA" * 3, "word " * 40_000 + "f" * 20]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kinds = [k for k, *_ in secret_scan.BASE]
    got = secret_scan.scan(df).select(
        "doc_id", *kinds, "random", secret_scan.listed(kinds).alias("l"), secret_scan.listed([*kinds, "random"]).alias("all"))
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id] or "")
        assert r.l == ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        assert [x for x in r.all.split(",") if x and not x.startswith("random")] == [x for x in r.l.split(",") if x]
        for s in r.random:  # added spans overlap no base span
            assert not any(a < s.end and s.start < b for a, _, b in want)


def test_battery_finds_random_tokens_only(spark):
    rng = random.Random(3)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()
    rows = [("random", "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=k)))
            for k in (24, 32, 40, 64) for _ in range(25)]
    rows += [("word", "".join(rng.choices(syllables, k=k))) for k in (10, 12, 15, 20, 40) for _ in range(40)]
    rows += [("digits", "".join(rng.choices(string.digits, k=15)) + " " + "-".join("2024" for _ in range(6))) for _ in range(20)]
    rows += [("repeat", c * 40) for c in "abXY_+"] + [("repeat", "abcABC123" * 5)]
    df = spark.createDataFrame([(i, k, f"see {t} here") for i, (k, t) in enumerate(rows)], "doc_id long, k string, text string")
    hits = {r.doc_id for r in secret_scan.scan(df).filter(F.size("random") > 0).collect()}
    found = {k: [i in hits for i, (kind, _) in enumerate(rows) if kind == k] for k in ("random", "word", "digits", "repeat")}
    assert sum(found["random"]) >= 95
    assert not any(found["word"]) and not any(found["digits"]) and not any(found["repeat"])


def found_by_kind(spark, rows):
    """Per kind, which tokens lie within one random span."""
    df = spark.createDataFrame([(i, f"see {t} here") for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    hits = {r.doc_id for r in secret_scan.scan(df).collect() if [(s.start, s.end) for s in r.random] == [(4, 4 + len(rows[r.doc_id][1]))]}
    out = {}
    for i, (k, _) in enumerate(rows):
        out.setdefault(k, []).append(i in hits)
    return out


def test_long_upper_case_hex_is_found(spark):
    rng = random.Random(8)
    rows = [(k, "".join(rng.choices("0123456789ABCDEF", k=k))) for k in (40, 64, 128) for _ in range(40)]
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()
    rows += [("text", "".join(rng.choices(syllables, k=k)).encode().hex().upper()) for k in (10, 16, 32) for _ in range(20)]
    rows += [("plain", t) for t in ("DEADBEEF" * 5, "0123456789ABCDEF" * 4, "FFFFFF000000" * 4, "C0FFEE" * 7, "AB" * 32)]
    found = found_by_kind(spark, rows)
    hits = {k: sum(v) for k, v in found.items()}
    assert hits[40] >= 28 and hits[64] >= 36 and hits[128] >= 36, hits  # a short key is near what text can look like
    assert not any(found["text"]) and not any(found["plain"])


def test_random_keys_of_every_encoding(spark):
    rng = random.Random(9)
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphabets = {"hex": "0123456789ABCDEF", "letters": low, "base32": up + "234567", "base32 low": low + "234567", "base36": low + num,
                 "base36 up": up + num, "base52": low + up, "base62": low + up + num, "base64": low + up + num + "+/"}
    rows = [((name, k), "".join(rng.choices(a, k=k))) for name, a in alphabets.items() for k in (24, 32, 40, 64, 100, 128)
            for _ in range(40)]
    words = "get user Name By Id Order list Total 2 set Value 3 from Page".split()
    rows += [("word", "".join(rng.choices(words, k=k))) for k in (8, 12, 20) for _ in range(40)]
    rows = [(k, t) for k, t in rows if len(t) >= 20]
    found = found_by_kind(spark, rows)
    hits = {k: sum(v) for k, v in found.items()}
    assert hits.pop("word") <= secret_scan.FALSE_DISCOVERIES * sum(hits.values()), hits
    assert all(hits[name, k] >= 35 for name in alphabets for k in (64, 100, 128)), hits
    large = [name for name in alphabets if name not in ("hex", "letters")]  # 16 and 26 symbols: a short key is near text
    assert all(hits[name, k] >= 32 for name in large for k in (32, 40)), hits
    assert all(hits[name, 24] >= 28 for name in large if not name.startswith("base32")), hits


def test_upper_tail(spark):
    from statistics import NormalDist

    zs = [-3.0, -1.0, 0.0, 0.5, 1.64, 2.33, 4.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", secret_scan.upper_tail(F.col("z")).alias("p"))
    for r in got.collect():
        assert abs(r.p - (1 - NormalDist().cdf(r.z))) < 3e-4


def test_empty_repeated_and_extra(spark):
    assert secret_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "f" * 16), (1, "f" * 16), (1, "f" * 16)], "doc_id long, text string")
    got = secret_scan.scan(df.withColumn("row", F.lit(1)).withColumn("hex", F.lit(2))).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"] and all(len(r.hex) == 1 for r in got)
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
