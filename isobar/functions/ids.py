"""Deterministic record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isobar.functions.times import as_column


def binary_text_id(text: Column | str) -> Column:
    """SHA-256 of a text whose characters are each written as 8 or more binary digits; those of ASCII are looked up."""
    text = as_column(text)
    ascii_bits = F.array(*[F.lit(format(k, "08b")) for k in range(128)])
    bits = F.transform(
        F.filter(F.split(text, ""), lambda c: c != ""),
        lambda c: F.coalesce(
            F.get(ascii_bits, F.ascii(c)),
            F.lpad(F.bin(F.ascii(c)), F.greatest(F.lit(8), F.length(F.bin(F.ascii(c)))), F.lit("0")),
        ),
    )
    return F.sha2(F.array_join(bits, ""), 256)


def concat_id(*parts: Column | str, null_text: str = "None") -> Column:
    """SHA-256 of the parts joined as text; a missing part counts as the text `None`."""
    return F.sha2(
        F.concat(*[F.coalesce(as_column(p).cast("string"), F.lit(null_text)) for p in parts]), 256
    )
