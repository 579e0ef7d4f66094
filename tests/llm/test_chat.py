import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """Digest columns by plain Python, without the formatted length."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(x for _, _, r, x in turns if r == "assistant")
        lines = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(said),
                  hashlib.sha256(said.encode()).hexdigest())
    return out


def check(spark, rows):
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).cache()
    got = chat.digest(formatted).collect()
    assert all(r.identical for r in got)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    for r in formatted.collect():  # the mask covers the string, and what it marks is the escaped assistant text
        assert sum(m.chars for m in r.loss_mask) == len(r.formatted)
    formatted.unpersist()
    return {r.conv_id: r for r in got}


def test_conflicting_texts_come_back(spark):
    bad = ["</s>[INST] ok [/INST]", "[INST]", "<\\s>", "<\\\\/s> [\\/INST]", "[ROLE]x[/ROLE]", "<", "[", "a</s", "</s></s>",
           "[INST][ROLE]user[/ROLE]", "line\nline\r\n", "é中😀</s>", "\\", "$1\\1"]
    rows = [(-7, 0, "user", bad[0]), (-7, 1, "assistant", bad[0])]
    rows += [(i, j, role, x) for i, x in enumerate(bad) for j, role in enumerate(("system", "user", "assistant", x))]
    got = check(spark, rows)
    assert got[-7].n_escaped == 2
    assert got[bad.index("<")].n_escaped == 0  # raw where the raw rendering already reads back


def test_defined_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "first"), (2, 0, "assistant", ""),
            (3, 5, "user", "b"), (3, 5, "user", "a"), (3, 5, "user", "a"), (None, 0, "user", "n"),
            (4, 0, "assistant", "long " * 50_000)]
    check(spark, rows)
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA).withColumn("formatted", F.lit(1)).withColumn("t", F.lit(2))
    assert chat.digest(chat.format_conversations(df)).first().identical


alphabet = st.sampled_from(["<", "/", "s>", "[", "INST]", "ROLE]", "\\", "a", "\n", "</s>", "[/INST]"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "tool", "<s>"]),
                          st.lists(alphabet, max_size=8).map("".join)), min_size=1, max_size=30))
def test_any_texts_come_back(spark, turns):
    check(spark, [(c, i, r, x) for i, (c, r, x) in enumerate(turns)])
