"""Access to source columns that a county file may or may not have."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions import casts, text


class Source:
    """Typed access to the (all-string) columns of a frame; an absent column reads as null."""

    def __init__(self, df: DataFrame):
        self._known = {c.lower() for c in df.columns}

    def has(self, name: str) -> bool:
        return name.lower() in self._known

    def raw(self, name: str) -> Column:
        return F.col(name) if self.has(name) else F.lit(None).cast("string")

    def filled(self, name: str) -> Column:
        """Trimmed text, null when blank."""
        return text.blank_to_null(self.raw(name))

    def text(self, name: str) -> Column:
        """Trimmed text, empty when null."""
        return text.text_or_empty(self.raw(name))

    def money(self, name: str) -> Column:
        return casts.money(self.raw(name))

    def whole(self, name: str) -> Column:
        return casts.safe_long(self.raw(name))

    def integer(self, name: str) -> Column:
        return casts.safe_int(self.raw(name))

    def double(self, name: str) -> Column:
        return casts.safe_double(self.raw(name))

    def yes(self, name: str) -> Column:
        return text.is_yes(self.raw(name))


def struct_of(**parts: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in parts.items()])
