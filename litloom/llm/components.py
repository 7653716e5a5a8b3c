"""Connected components of a table of links, by label propagation with pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import forget, staged


def components(links: DataFrame) -> DataFrame:
    """v, root for every end of links (a, b: long): root is the smallest end that links reach from v.

    Each round gives an end the smallest root of its neighbours and itself, and then that root's own root, so
    chains shrink by more than half; rounds end when none changes. Self-links and repeated links do no harm.
    Links are combined for each end before they are shuffled. No links, no rows.
    """
    both = staged(links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select("b", "a")).distinct(), "links")
    now = last = staged(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("root")), "roots")
    while True:
        near = both.join(now.select(F.col("v").alias("u"), "root"), "u").groupBy("v").agg(F.min("root").alias("near"))
        # hooked: what a root's members have found is given to the root too
        stepped = now.join(near, "v", "left").select("v", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root"))
        hooks = stepped.filter("root < old").groupBy(F.col("old").alias("v")).agg(F.min("root").alias("hook"))
        hooked = staged(stepped.join(hooks, "v", "left").select("v", "old", F.least("root", F.coalesce("hook", "root")).alias("root")), "hooked")
        jump = hooked.select(F.col("v").alias("root"), F.col("root").alias("next"))
        after = staged(hooked.join(jump, "root", "left").select("v", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("old")).alias("changed")), "roots")
        forget(last, hooked)
        last = after
        if after.filter("changed").isEmpty():
            forget(both)
            return after.select("v", "root")
        now = after.select("v", "root")
