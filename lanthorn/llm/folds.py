"""Places of matches in a text by DataFrame functions, linear in the number of matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: elements that one fold gathers; its array is copied at every step, so longer ones are put together from groups
GROUP = 256


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def placed(elements: Column, none: Column, shifted) -> Column:
    """The ``found`` arrays of ``elements`` (array of struct(len, found)) behind one another, each moved to its place.

    An element begins where those before it, of ``len`` characters each, end; ``shifted(x, by)`` moves one found item.
    """
    def step(a, x):
        more = F.concat(a["out"], F.transform(x["found"], lambda s: shifted(s, a["at"])))
        return F.struct((a["at"] + x["len"]).alias("at"), F.when(F.size(x["found"]) > 0, more).otherwise(a["out"]).alias("out"))

    zero = F.lit(0)

    def group(z, g):
        return F.aggregate(F.slice(z, g * GROUP + 1, F.lit(GROUP)), F.struct(zero.alias("at"), none.alias("out")), step)

    def starts(groups):
        add = lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(groups, F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out")), add, lambda a: a["out"])

    def joined(groups):
        moved = F.zip_with(groups, starts(groups), lambda x, by: F.transform(x["out"], lambda s: shifted(s, by)))
        return F.flatten(moved)

    def grouped(z):
        last = F.floor((F.size(z) - 1) / GROUP).cast("int")
        return once(F.transform(F.sequence(zero, F.greatest(last, zero)), lambda g: group(z, g)), joined)

    return once(elements, grouped)
