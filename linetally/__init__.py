"""linetally: an order-line analytics engine written for PySpark.

Raw order lines are landed untouched, converted month by month to Parquet with
every source line accounted for, staged with numbered duplicates, reconciled
hop by hop, and rolled up into a star schema.
"""
