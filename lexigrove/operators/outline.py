"""The tree of a book's contents, from the levels of its entries in order.

No row waits for another: for every level a window knows the last entry before a row, and the
first one after it.  Of those the row itself tells which are its ancestors, and where its
part of the book ends.  A subtree is a range of numbers, so descendants of any depth are found
by comparing numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Levels of a table of contents; each costs two window functions.
DEEPEST = 64


def nested_sets(entries: DataFrame, order: str = "seq", level: str = "level", name: str = "title") -> DataFrame:
    """``entries`` (book, order, level, name) with `parent`, `depth`, `left`, `right`, `ancestors` and `path`.

    An entry's parent is the last one before it of a smaller level.  `left` numbers a book's
    entries from 1, `right` is the number of the last entry below it, its own if there is none.
    `ancestors` are numbers from the root down; `path` has their names and the entry's.  Levels
    are integers from 1 to `DEEPEST` (others are an error); steps may skip levels.
    """
    found = entries.agg(F.min(level).alias("least"), F.max(level).alias("most"), F.count_if(F.col(level).isNull()).alias("none")).first()
    if found["least"] is not None and (found["least"] < 1 or found["most"] > DEEPEST):
        raise ValueError(f"levels must lie between 1 and {DEEPEST}")
    if found["none"]:
        raise ValueError("entries must have a level")
    levels = range(1, (found["most"] or 1) + 1)
    by = Window.partitionBy("book").orderBy(order)
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    numbered = entries.withColumn("left", F.row_number().over(by))
    at = lambda n: F.col(level) == n
    own = F.struct("left", F.col(name).alias("name"))
    rows = numbered.withColumns(
        {
            "above": F.array(*(F.last(F.when(at(n), own), ignorenulls=True).over(before) for n in levels)),
            "next": F.array(*(F.first(F.when(at(n), F.col("left")), ignorenulls=True).over(after) for n in levels)),
            "entries": F.count(F.lit(1)).over(Window.partitionBy("book")).cast("int"),
        }
    )

    def open_(held: Column, x: Column) -> Column:
        """An entry of a level is an ancestor if none of a smaller level stands behind it."""
        shut = F.size(F.filter(held, lambda h: h["left"] > x["left"])) > 0
        return F.when(x.isNull() | shut, held).otherwise(F.concat(held, F.array(x)))

    start = F.array().cast("array<struct<left:int,name:string>>")
    stack = F.aggregate(F.slice("above", F.lit(1), F.col(level).cast("int") - 1), start, open_)
    ends = F.array_min(F.filter(F.slice("next", F.lit(1), F.col(level).cast("int")), lambda x: x.isNotNull()))
    rows = rows.withColumns({"stack": stack, "right": F.coalesce(ends - 1, F.col("entries"))})
    names = F.concat(F.transform("stack", lambda x: F.coalesce(x["name"], F.lit(""))), F.array(F.coalesce(F.col(name), F.lit(""))))
    out = rows.withColumns({"ancestors": F.transform("stack", lambda x: x["left"]), "path": F.array_join(names, " > "), "depth": F.size("stack") + 1})
    return out.withColumn("parent", F.try_element_at("ancestors", F.lit(-1))).drop("above", "next", "entries", "stack")


def children(nested: DataFrame) -> DataFrame:
    """(book, parent, children): the numbers of the entries right below each entry, in order; roots stand under null."""
    return nested.groupBy("book", "parent").agg(F.array_sort(F.collect_list("left")).alias("children"))


def descendants(nested: DataFrame, roots: DataFrame) -> DataFrame:
    """(book, root, left, depth) of all entries under the entries of ``roots`` (book, root), themselves included.

    An entry carries its ancestors, so this is an equality join with those, not a range join.
    """
    each = nested.select("book", "left", "depth", F.explode(F.concat("ancestors", F.array("left"))).alias("root"))
    return each.join(roots.select("book", "root").distinct(), ["book", "root"]).select("book", "root", "left", "depth")
