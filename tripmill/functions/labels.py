"""Code-to-label expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schema import OTHER_PAYMENT_PREFIX, PAYMENT_NAMES


def lookup(labels: dict[int, str], code: Column) -> Column:
    """Label of a code, null where the table has none. The map folds to a literal."""
    entries = [F.lit(x) for pair in labels.items() for x in pair]
    return F.create_map(*entries)[code.cast("int")]


def payment_label(code: Column) -> Column:
    """Payment name; a code without a name shows the code, a null code stays null."""
    fallback = F.concat(F.lit(OTHER_PAYMENT_PREFIX), code.cast("string"))
    return F.coalesce(lookup(PAYMENT_NAMES, code), fallback)
