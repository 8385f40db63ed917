"""Finite-state machines over long ordered groups, as a parallel prefix of state maps.

A block of rows acts on a machine as a map from each state to the state it ends in.  Maps
compose in a tree: blocks of `FAN` maps become one map, until a group is one block; then the
states before all blocks follow from the top down.  No task folds more than `FAN` maps of a
group, however long the group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Maps that are composed in one row.
FAN = 64


def composed(maps: Column, states: int) -> Column:
    """The map that applies an array of maps (arrays with the next state of each) one after the other."""
    start = F.array(*(F.lit(s) for s in range(states)))
    return F.aggregate(maps, start, lambda done, m: F.transform(done, lambda s: F.get(m, s)))


def states_before(maps: Column, start: Column) -> Column:
    """The state before each map of an array, of a machine that begins in ``start``."""
    ends = F.aggregate(maps, F.array(start), lambda done, m: F.concat(done, F.array(F.get(m, F.element_at(done, -1)))))
    return F.slice(ends, 1, F.size(maps))


def _folded(level: DataFrame, group: str, states: int, fan: int) -> DataFrame:
    """Blocks of a level: (group, pos, members, map), where members are in order."""
    member = F.struct("pos", "map")
    blocks = level.groupBy(group, F.floor(F.col("pos") / fan).cast("long").alias("pos")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return blocks.withColumn("map", composed(F.transform("members", lambda x: x["map"]), states))


def prefix_states(maps: DataFrame, group: str, states: int, start: int = 0, fan: int = FAN) -> DataFrame:
    """(group, pos, state): the state before each of ``maps`` (group, pos, map), in order of the integer `pos`.

    `map` has the state that follows each of the ``states`` states; positions may have gaps,
    and no two rows of a group have the same.  Groups begin in ``start``.  A null group is a
    group like any other.
    """
    far = maps.agg(F.max("pos").alias("last"), F.min("pos").alias("first")).first()
    if far["last"] is None:
        return maps.select(group, "pos", F.lit(start).alias("state"))
    level = maps.select(group, (F.col("pos") - far["first"]).cast("long").alias("pos"), F.col("map").cast("array<int>").alias("map"))
    levels, reach = [], far["last"] - far["first"]
    while True:
        level = _folded(level, group, states, fan)
        levels.append(level)
        reach //= fan
        if reach < 1:
            break
    known = levels.pop().withColumn("state", F.lit(start))
    while True:
        each = F.arrays_zip(F.col("members").alias("m"), states_before(F.transform("members", lambda x: x["map"]), F.col("state")).alias("s"))
        below = known.select(F.col(group).alias("of_group"), F.explode(each).alias("x")).select("of_group", F.col("x.m.pos").alias("of_pos"), F.col("x.s").alias("state"))
        if not levels:
            return below.select(F.col("of_group").alias(group), (F.col("of_pos") + far["first"]).alias("pos"), "state")
        blocks = levels.pop()
        known = blocks.join(below, F.col(group).eqNullSafe(F.col("of_group")) & (F.col("pos") == F.col("of_pos"))).select(group, "pos", "members", "state")
