"""shelfwise: retail inventory analytics as Spark DataFrame jobs.

Sales transactions, daily stock snapshots, products, suppliers and
warehouses go in; cleaned tables, business views, the analytical query
set, ABC/XYZ classification, replenishment parameters, demand forecasts
and per-(SKU, warehouse) health scores come out.  Every operator is a
function from DataFrames to a DataFrame, so Catalyst sees one plan.
"""

__all__ = ["session"]
