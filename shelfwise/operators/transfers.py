"""P06 as a plan: which warehouse ships how many units of a SKU to which other one.

Donors' excess and receivers' shortage are laid end to end along one axis per
SKU.  Every end of a donor or receiver is a cut; between two cuts there is one
donor and one receiver, so a SKU gives at most donors + receivers - 1 rows and
no donor x receiver pairs are ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def offers(recs: DataFrame, overstock: int = 4) -> DataFrame:
    """(product_id, warehouse_id, side, qty): what a warehouse can give (side ``from``) or needs (``to``).

    It gives what lies above ``overstock`` x safety stock and needs what is
    missing to the reorder point.  A warehouse below its reorder point gives
    nothing, whatever its safety stock; without parameters it does neither.
    """
    short = F.col("rop") - F.col("stock_on_hand")
    excess = F.col("stock_on_hand") - F.col("safety_stock") * overstock
    side = F.when(short > 0, "to").when((excess > 0) & (short <= 0), "from")
    return (recs.select("product_id", "warehouse_id", side.alias("side"), F.when(short > 0, short).otherwise(excess).cast("long").alias("qty"))
            .where(F.col("side").isNotNull()))


def transfer_plan(offered: DataFrame) -> DataFrame:
    """(product_id, step, from_warehouse, to_warehouse, qty): the transfers of each SKU, numbered from 1.

    Large offers and needs come first, the warehouse id breaks ties.  A SKU
    moves min(its excess, its shortage) units.  The rows of a SKU meet in one
    task: they are as many as the SKU has warehouses, whatever the sales.
    """
    sku = Window.partitionBy("product_id")
    upto = Window.partitionBy("product_id", "side").orderBy(F.desc("qty"), "warehouse_id").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("qty"))).over(sku), F.lit(0))
    cuts = (offered.withColumns({"end": F.sum("qty").over(upto), "moved": F.least(total("from"), total("to"))})
            .where(F.col("end") - F.col("qty") < F.col("moved"))
            .withColumn("cut", F.least("end", "moved")))
    # From the last cut back: the donor of a stretch is the one whose end was met last, likewise the receiver.
    back = Window.partitionBy("product_id").orderBy(F.desc("cut"))
    seen = back.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    who = lambda s: F.last(F.when(F.col("side") == s, F.col("warehouse_id")), ignorenulls=True).over(seen)
    stretches = cuts.select("product_id", "cut", who("from").alias("from_warehouse"), who("to").alias("to_warehouse"),
                            (F.col("cut") - F.coalesce(F.lead("cut").over(back), F.lit(0))).alias("qty"))
    step = F.row_number().over(Window.partitionBy("product_id").orderBy("cut"))
    return (stretches.where(F.col("qty") > 0)
            .select("product_id", step.cast("long").alias("step"), "from_warehouse", "to_warehouse", "qty"))
