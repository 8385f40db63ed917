"""Trees of contents against a plain stack, at all depths."""

import random

import pytest

from lexigrove.operators import outline as O

SCHEMA = "book string, seq int, level int, title string"


def plain(levels):
    """(parent, right, depth, ancestors) of each entry, with a stack."""
    out, stack = [], []
    for i, level in enumerate(levels, 1):
        while stack and levels[stack[-1] - 1] >= level:
            stack.pop()
        last = next((j for j in range(i + 1, len(levels) + 1) if levels[j - 1] <= level), len(levels) + 1) - 1
        out.append((stack[-1] if stack else None, last, len(stack) + 1, list(stack)))
        stack.append(i)
    return out


def test_trees_equal_a_stack(spark):
    rng = random.Random(2)
    books = {f"b{k}": [rng.randrange(1, 2 + k) for _ in range(rng.randrange(1, 90))] for k in range(12)}
    books |= {"deep": list(range(1, 51)) + list(range(50, 0, -1)), "flat": [3] * 20, "skips": [1, 9, 5, 9, 1, 50, 2], None: [2, 1, 2]}
    rows = [(b, 10 * i, level, f"t{i}") for b, levels in books.items() for i, level in enumerate(levels, 1)]
    rng.shuffle(rows)
    nested = O.nested_sets(spark.createDataFrame(rows, SCHEMA)).cache()
    got = {}
    for r in nested.orderBy("book", "left").collect():
        got.setdefault(r.book, []).append((r.parent, r.right, r.depth, r.ancestors))
        assert r.path == " > ".join(f"t{i}" for i in [*r.ancestors, r.left])
    assert got == {b: plain(levels) for b, levels in books.items()}
    below = {(r.book, r.root, r.left) for r in O.descendants(nested, nested.selectExpr("book", "left AS root")).collect() if r.book is not None}
    assert below == {(r.book, r.left, k) for r in nested.collect() if r.book is not None for k in range(r.left, r.right + 1)}
    kids = {(r.book, r.parent): r.children for r in O.children(nested).collect()}
    assert kids["deep", None] == [1, 100] and kids["deep", 1] == [2, 99] and kids["flat", None] == list(range(1, 21)) and kids[None, None] == [1, 2]


@pytest.mark.parametrize("level", [0, 65, None])
def test_levels_out_of_range_are_errors(spark, level):
    with pytest.raises(ValueError):
        O.nested_sets(spark.createDataFrame([("b", 1, level, "x"), ("b", 2, 1, "y")], SCHEMA))


def test_edges(spark):
    assert O.nested_sets(spark.createDataFrame([], SCHEMA)).collect() == []
    one = O.nested_sets(spark.createDataFrame([("b", None, 4, None)], SCHEMA)).first()
    assert (one.left, one.right, one.parent, one.depth, one.path) == (1, 1, None, 1, "")
