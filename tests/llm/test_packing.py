import random
import string
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import packing

SCHEMA = "doc_id long, text string"


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


ODD = ["", "İstanbul ΣΑΣ ŉ ǅ don't we'll 12 34 é ́x 가각", "a​b ﻿c", "日本語 テスト。", "'s 't s' ''s", "a\x1cb\x1d c",
       "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "x" * 3000, "Word, word. WORD.. ,word", "Ééà, ß. µ ª º", " a　b\x85c\xa0d"]


def test_word_table_matches_the_tokenizer():
    tok, enc = tokenizer(), packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    rng = random.Random(1)
    letters = [chr(c) for c in range(33, 0x180)]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))) + rng.choice(["", ".", ",", ".."]) for _ in range(3000)]
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ODD + words + [f"ab{c}Cd{c}" for c in spaces] + [" ".join(words)]
    for t in texts:
        assert b"".join(enc.blocks(t)) == np.asarray(ids_of(tok, t), "<u4").tobytes(), t[:50]


def test_letters_and_marks_are_looked_up_apart():
    tok, enc, whole = tokenizer(), packing.Encoder(public_tokenizers.path(packing.TOKENIZER)), []

    class Counted:
        def encode(self, text, **args):
            whole.append(text)
            return tok.encode(text, **args)

    enc.tok = Counted()
    rng = random.Random(3)
    marks = ["", ",", "***", ".%%%", "_!", "''", "<|"] + ["".join(rng.choices(string.punctuation, k=3)) for _ in range(500)]
    text = " ".join(w + m for w in ("word", "Word", "été", "Été") for m in marks) + " word's 12*** 0xff don't"
    assert b"".join(enc.blocks(text)) == np.asarray(ids_of(tok, text), "<u4").tobytes()
    # only marks, once each, and words that are not letters and marks go through the whole tokenizer
    assert sorted(w for w in whole if w.strip(string.punctuation)) == ["0xff", "12***", "don't", "word's"]
    assert len(whole) == len(set(whole))


def test_latin_words_have_one_entry_whatever_their_case():
    tok, enc = tokenizer(), packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    for t in ["Foo foo FOO fOO", "Éa éa ÉA", "Foo <|STARTOFTEXT|> FOO<|EndOfText|>", "foo İ FOO Σ"]:
        assert b"".join(enc.blocks(t)) == np.asarray(ids_of(tok, t), "<u4").tobytes(), t
    enc.known.clear()
    list(enc.blocks("Foo foo FOO fOO Éa éa ÉA"))
    assert sorted(enc.known) == ["foo", "éa"]


def test_small_tables_and_blocks(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    monkeypatch.setattr(packing, "BLOCK_CHARS", 50)
    tok, enc = tokenizer(), packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    text = " ".join(f"word{chr(97 + i % 26)}, Other{'abc'[i % 3] * (i % 7)}" for i in range(400))
    assert b"".join(enc.blocks(text)) == np.asarray(ids_of(tok, text), "<u4").tobytes()


def test_knapsack_is_best():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = np.unique(rng.integers(1, 13, 6))
        value = rng.random(len(sizes))
        best, counts = packing.knapsack(value, sizes, 12)
        assert (counts * sizes).sum() <= 12
        table = np.zeros(13)
        for c in range(1, 13):
            table[c] = max([table[c - 1]] + [table[c - s] + v for s, v in zip(sizes, value) if s <= c])
        assert abs(best - table[12]) < 1e-12 and abs((counts * value).sum() - best) < 1e-12


def test_classes_round_up_a_little():
    for sequence in (1, 64, 256, 2048):
        sizes = packing.class_sizes(sequence)
        assert sizes[0] == 1 and sizes[-1] == sequence and (np.diff(sizes) > 0).all()
        n = np.arange(1, sequence + 1)
        up = sizes[np.searchsorted(sizes, n)]
        assert (up >= n).all() and (up[n <= 64] == n[n <= 64]).all() and ((up - n) <= n / 32).all()
    assert len(packing.class_sizes()) < 400


def check_plan(demand, sizes, capacity=2048):
    plan = packing.plan_sequences(demand, sizes, capacity)
    used = np.zeros(len(sizes), int)
    for pattern, times in plan:
        assert times > 0 and sum(sizes[c] * k for c, k in pattern.items()) <= capacity
        for c, k in pattern.items():
            used[c] += k * times
    assert (used == demand).all()
    return sum(times for _, times in plan)


def test_plans_use_each_piece_once_with_little_padding():
    rng = np.random.default_rng(4)
    sizes = packing.class_sizes()
    assert check_plan(np.zeros(len(sizes), int), sizes) == 0
    for n in (1, 7, 300, 30_000):
        for lengths in (rng.integers(1, 2049, n), np.minimum(2048, 1 + rng.exponential(300, n).astype(int)), rng.integers(1, 20, n),
                        np.full(n, 3)):
            used = check_plan(np.bincount(np.searchsorted(sizes, lengths), minlength=len(sizes)), sizes)
            assert used <= -(-lengths.sum() // 2048) * 1.03 + 5
    # a case whose optimum is known: 100 of a half and 200 of a quarter
    assert check_plan(np.array([200, 100]), np.array([512, 1024])) == 100


def check(spark, rows, **args):
    tok = tokenizer()
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), **args).toPandas()
    size = args.get("sequence", packing.SEQUENCE)
    want = sorted((len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())) for ids in
                  (ids_of(tok, t) + [packing.END_ID] for _, t in rows))
    # pieces: cut a document's ids at its starts and compare digests
    by_doc = {}
    for (d, t) in rows:
        by_doc.setdefault(d, []).append(ids_of(tok, t) + [packing.END_ID])
    assert out["length"].sum() == sum(n for n, _ in want)
    for r in out.itertuples():
        d = None if r.doc_id != r.doc_id else int(r.doc_id)
        assert any(len(ids) == r.doc_tokens and zlib.crc32(np.asarray(ids[r.start:r.start + r.length], "<u4").tobytes())
                   == r.ids_crc32 for ids in by_doc[d])
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"] == g["length"].cumsum() - g["length"]).all() and g["length"].sum() <= size
        n = int(g["length"].sum())
        assert (g["padding"] == (0 if n & (n - 1) == 0 else size - n)).all()
    assert sorted(out["sequence_id"].unique()) == list(range(out["sequence_id"].nunique()))
    return out


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "of", "thon,", "Erst."], k=rng.randint(0, 900)))) for i in range(80)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (7, "again"), (7, "again"), (200, None), (201, "ab " * 20_000)]
    out = check(spark, rows, sequence=256)
    assert out.drop_duplicates("sequence_id")["padding"].sum() < 0.05 * out["length"].sum()
    check(spark, rows[:5])


def test_documents_over_half_a_sequence_are_cut(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 20)
    rng = random.Random(12)
    word = lambda n: " ".join(rng.choices(["the", "of", "and"], k=n - 1))
    same, copy = [(i, word(1100)) for i in range(150)], word(1100)
    mixed = [(i, copy if i % 3 == 0 else word(rng.randint(2, 2047))) for i in range(150)] + [(1, "the " * 5000)]
    for rows in (same, mixed):
        out = check(spark, rows)
        assert len({ids_of(tokenizer(), w)[0] for w in ("the", "of", "and")}) == 3 and out["doc_tokens"].min() > 1
        for _, g in out[out["doc_id"] != 1].sort_values("start").groupby("doc_id"):  # every id lies in one piece
            assert (g["start"] == g["length"].cumsum() - g["length"]).all() and g["length"].sum() == g["doc_tokens"].iloc[0]
        n = out["sequence_id"].nunique()
        assert n <= 1.02 * out["length"].sum() / 2048 + 1, (n, out["length"].sum())


def test_hot_class_is_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 7)
    out = check(spark, [(i, "same text") for i in range(200)] + [(500, "x y z")], sequence=64)
    assert out.drop_duplicates("sequence_id")["padding"].sum() <= 64


def test_empty_and_extra_columns(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "x")], SCHEMA).withColumn("row", F.lit("a")).withColumn("length", F.lit(2))
    assert packing.pack(df).count() == 1
