from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, rendered int"


def brute(rows):
    """Every conversation against every other, turn by turn; turn numbers are distinct here."""
    convs = defaultdict(list)
    for c, n, role, text, _ in rows:
        convs[c].append((n, role, text))
    turns = {c: [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0]))] for c, ts in convs.items()}
    out = {}
    for c, ts in turns.items():
        longer = any(len(o) > len(ts) and o[:len(ts)] == ts for o in turns.values())
        equal = [k for k, o in turns.items() if o == ts]
        first = min((k for k in equal if k is not None), default=None)
        if not longer and c == first:
            out[c] = "".join(f"<|im_start|>{'unknown' if r is None else r}\n{(x or '').replace('<|im_', '<| im_')}<|im_end|>\n" for r, x in ts)
    return out


def conv(c, *texts, start=0, step=1):
    return [(c, start + step * i, "user" if i % 2 == 0 else "assistant", t, 1) for i, t in enumerate(texts)]


ROWS = [*conv(1, "a"), *conv(2, "a", "b"), *conv(3, "a", "b", "c"), *conv(4, "a", "x"), *conv(5, "a", "b", "c"), *conv(None, "a", "b", "c"),
        *conv(6, "", "q"), *conv(7, None, "q"), *conv(8, None), *conv(9, "b", "a"), *conv(10, "ab", "c"), *conv(11, "a", "bc"),
        (12, None, None, None, 1), (13, 5, None, None, 1), (13, 6, "user", "<|im_end|>", 1), *conv(14, *map(str, range(3000))),
        *conv(15, *map(str, range(2048))), *conv(16, *map(str, range(2047)), "other"), *conv(17, "z", "y", start=3, step=5000),
        *conv(18, "z", "y", "x", start=1), (20, 0, "assistant", "a", 1), *conv(21, "long " * 50000)]


def joined(df):
    out, parts = defaultdict(list), {}
    for r in df.collect():
        out[r.conv_id].append((r.part if r.part is not None else -1, r.rendered))
        parts[r.conv_id] = r.n_turns
    return {c: "".join(x for _, x in sorted(v)) for c, v in out.items()}, parts


def test_matches_brute_force(spark):
    got, turns = joined(chat.formatted(spark.createDataFrame(ROWS, SCHEMA).repartition(5)))
    want = brute(ROWS)
    assert got == want
    assert turns[14] == 3000 and 15 not in got and 17 not in got and 18 in got


def test_equal_conversations_without_a_number(spark):
    got, _ = joined(chat.formatted(spark.createDataFrame(conv(None, "a", "b"), SCHEMA)))
    assert list(got) == [None]


def test_repeated_rows_are_turns(spark):
    rows = [*conv(1, "a", "b"), conv(1, "a")[0], *conv(2, "a", "b")]
    _, turns = joined(chat.formatted(spark.createDataFrame(rows, SCHEMA)))
    assert turns == {1: 3, 2: 2}


@pytest.mark.parametrize("empty", [True])
def test_empty_table(spark, empty):
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_runs_no_python(spark):
    df = chat.formatted(spark.createDataFrame(conv(1, "a"), SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert df.select(F.col("n_turns")).first()[0] == 1


def test_the_table_is_read_three_times(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "turns"))
    turns = spark.read.parquet(str(tmp_path / "turns"))
    place = str(tmp_path / "turns")
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count(place)
    assert scans(chat.formatted(turns)) == 1  # the other two write the prefixes
    got, _ = joined(chat.formatted(turns))
    assert got == brute(ROWS)
