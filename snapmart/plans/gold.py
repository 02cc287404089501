"""Complete-case monthly snapshots: labels joined with every feature table."""

from functools import reduce

from pyspark.sql import DataFrame

from snapmart.operators.rows import drop_unknown_rows, keep_last, normalize_key, require_columns

FEATURE_ORDER = ("contract", "service", "demographic", "financial")


def latest_features(df: DataFrame, name: str, key: str, order: str, snap: str = "snapdate") -> DataFrame:
    """Complete rows of a feature table, the last one per key; its own date is kept under a prefix."""
    df = keep_last(drop_unknown_rows(normalize_key(df, key), skip=(order,)), key, order).drop(order)
    return df.withColumnRenamed(snap, f"{name}_{snap}")


def join_tables(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``; a column that both sides have becomes ``_x`` (left) and ``_y`` (right).

    Merged, never broadcast: a customer table of a few compressed megabytes is many times that in the driver, and several are joined at once.
    """
    both = set(left.columns) & set(right.columns) - {key}
    return (left.withColumnsRenamed({c: f"{c}_x" for c in both})
            .join(right.withColumnsRenamed({c: f"{c}_y" for c in both}).hint("merge"), key))


def gold_snapshot(labels: DataFrame, features: dict[str, DataFrame], key: str = "customerID",
                  snap: str = "snapdate", order: str = "ord_") -> DataFrame:
    """Labels of all months with the feature row of their customer; all inner joins on ``key``.

    Labels and features are reduced to one row per (key, month) and per key *before* the joins,
    in aggregates that combine map-side. Keep-last and the token filter look at one input at a
    time, so their result is the same as after the joins, and no key can be hot in a join. The
    feature tables come out of their aggregates partitioned by the key and are joined with each
    other in place; only the labels are shuffled again.
    """
    labels = drop_unknown_rows(normalize_key(require_columns(labels, key, snap, order), key), skip=(order,))
    labels = keep_last(labels, [key, snap], order).drop(order)
    names = [n for n in FEATURE_ORDER if n in features] + [n for n in features if n not in FEATURE_ORDER]
    rows = [latest_features(features[n], n, key, order, snap) for n in names if key in features[n].columns]
    if not rows:
        return labels
    return join_tables(labels, reduce(lambda a, b: join_tables(a, b, key), rows), key)
