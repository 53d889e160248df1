"""The operators on conversations against plain Python, on every kind of odd row."""

import random

import pytest
from brute_turns import brute_repairs, brute_trie, damaged
from pyspark.sql import functions as F

from matchboard.llm import turn_repair
from matchboard.llm.prefix_trie import prefix_trie
from matchboard.llm.turn_repair import repair_report, repaired_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _rows():
    rng = random.Random(3)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(0, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(["Hi.", "Yes", "no!", "", " \t", "Why?", None, "é 東"])))
    # one conversation much longer than a chunk, with long runs of turns to delete and none
    for turn in range(900):
        same = 200 < turn < 500
        rows.append((77, turn, ("user", "assistant")[turn % 2], "again." if same else f"{turn}{rng.choice('.!x')}"))
    rows += [(5, None, "user", "first"), (5, None, None, None), (5, 2, "user", "tie"), (5, 2, "assistant", "tie.")]
    rows += [(None, 1, "user", "Hi."), (None, 0, "system", "x"), (9, 1, "user", "Hi.")] * 2
    rows += [(2**40, 0, "user", "long " * 20000), (2**40, 7, "assistant", "é" * 30000), (-7, 0, "user", "minus")]
    return rows


@pytest.fixture(scope="module")
def rows_():
    return _rows()


@pytest.fixture(scope="module")
def frame(spark, rows_):
    clash = [F.lit("x").alias(c) for c in ("conv", "chunk", "place", "node", "mark", "plan", "near", "fate", "copy", "state")]
    return spark.createDataFrame(rows_, SCHEMA).repartition(5).select("*", *clash)


@pytest.mark.parametrize("size", [1024, 16, 1])
def test_repairs_equal_brute_force(frame, rows_, size):
    got = sorted(map(tuple, repair_report(frame, size).collect()), key=repr)
    assert got == sorted(brute_repairs(rows_), key=repr)


def test_repairs_of_no_rows(spark):
    assert repair_report(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_fix_up_equals_a_run_from_the_start():
    """Chunks that start from a guess come to the costs of one sequential run."""
    rng = random.Random(4)
    for _ in range(300):
        first, second = ("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(1, 30))) for _ in "ab")
        whole = turn_repair.backward(first + second, turn_repair.END)
        start = turn_repair.backward(first, turn_repair.GUESS)[0]
        given = turn_repair.backward(second, turn_repair.END)[0]
        assert turn_repair.fixed_up(first, turn_repair.GUESS, given, start) == whole[0]


def test_repaired_turns_alternate(frame, rows_):
    """The repaired rows of undamaged conversations read s?(ua)+ or nothing."""
    got = repaired_turns(frame, 16).orderBy("conv", "chunk", "number").collect()
    by_conv = {}
    for row in got:
        by_conv.setdefault(row["conv"], []).append(row["role"][:1])
    assert by_conv and "77" in by_conv
    for initials in by_conv.values():
        text = "".join(initials)
        rest = text.removeprefix("s")
        assert rest == "ua" * (len(rest) // 2)


def test_damage_is_that_of_the_contract(frame, rows_):
    counts = {("" if c is None else c): len(t) for c, t in damaged(rows_).items()}
    got = turn_repair.damage(frame).groupBy("conv").count().collect()
    assert {r["conv"]: r["count"] for r in got} == {str(c) if c != "" else " ": n for c, n in counts.items() if n}


@pytest.mark.parametrize("height", [16, 4, 2])
def test_trie_equals_brute_force(frame, rows_, height):
    got = sorted(map(tuple, prefix_trie(frame, height).collect()), key=repr)
    assert got == sorted(brute_trie(rows_), key=repr)


def test_trie_of_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).isEmpty()
