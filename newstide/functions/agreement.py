"""Whether sentiment and price moved the same way."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sign_agreement(sentiment: Column, change: Column) -> Column:
    """1.0 when both rise, -1.0 when both fall, 0.0 otherwise and for NULL."""
    return (
        F.when((sentiment > 0) & (change > 0), 1.0)
        .when((sentiment < 0) & (change < 0), -1.0)
        .otherwise(0.0)
    )


def product_sign(sentiment: Column, change: Column) -> Column:
    """1.0 when the product is above 0, else 0.0; NULL for NULL."""
    product = sentiment.cast("double") * change.cast("double")
    return F.when(product.isNull(), F.lit(None).cast("double")).when(product > 0, 1.0).otherwise(0.0)
