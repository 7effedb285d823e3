"""Boxes as Column expressions. A box is half-open; all of these stay in generated code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(x: Column) -> Column:
    """Rounded half to even, as a whole number."""
    return F.rint(x).cast("long")


@dataclass(frozen=True)
class Box:
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, alias: str = "", struct: str | None = None) -> Box:
        """The columns x1..y2 of a frame alias, or the fields of a struct column."""
        at = f"{alias}." if alias else ""
        at += f"{struct}." if struct else ""
        return cls(*(F.col(f"{at}{c}") for c in ("x1", "y1", "x2", "y2")))

    @classmethod
    def element(cls, x: Column) -> Box:
        return cls(x["x1"], x["y1"], x["x2"], x["y2"])

    def columns(self) -> list[Column]:
        return [c.alias(n) for c, n in zip((self.x1, self.y1, self.x2, self.y2), ("x1", "y1", "x2", "y2"))]

    def struct(self) -> Column:
        return F.struct(*self.columns())

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def cx(self) -> Column:
        return (self.x1 + self.x2) / 2.0

    @property
    def cy(self) -> Column:
        return (self.y1 + self.y2) / 2.0

    def clip(self, w, h) -> Box:
        """Within the page, a pixel wide and high at least."""
        x1, y1 = F.greatest(F.lit(0), F.least(self.x1, F.lit(w - 1))), F.greatest(F.lit(0), F.least(self.y1, F.lit(h - 1)))
        return Box(x1, y1, F.greatest(x1 + 1, F.least(self.x2, F.lit(w))), F.greatest(y1 + 1, F.least(self.y2, F.lit(h))))

    def area(self) -> Column:
        return (F.greatest(F.lit(0), self.width) * F.greatest(F.lit(0), self.height)).cast("long")

    def intersection(self, o: Box) -> Column:
        w = F.least(self.x2, o.x2) - F.greatest(self.x1, o.x1)
        h = F.least(self.y2, o.y2) - F.greatest(self.y1, o.y1)
        return (F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)).cast("long")

    def iou(self, o: Box) -> Column:
        both = self.intersection(o)
        return F.when(both == 0, F.lit(0.0)).otherwise(both / (self.area() + o.area() - both).cast("double"))

    def union(self, o: Box) -> Box:
        return Box(F.least(self.x1, o.x1), F.least(self.y1, o.y1), F.greatest(self.x2, o.x2), F.greatest(self.y2, o.y2))

    def h_overlap(self, o: Box) -> Column:
        """Shared width over the narrower width."""
        return cross_overlap(self.x1, self.x2, o.x1, o.x2)

    def v_overlap(self, o: Box) -> Column:
        return cross_overlap(self.y1, self.y2, o.y1, o.y2)

    def v_gap(self, o: Box) -> Column:
        return axis_gap(self.y1, self.y2, o.y1, o.y2)

    def h_gap(self, o: Box) -> Column:
        return axis_gap(self.x1, self.x2, o.x1, o.x2)

    def per_mille(self, w, h) -> Box:
        """In thousandths of the page."""
        w, h = F.greatest(F.lit(1), F.lit(w)), F.greatest(F.lit(1), F.lit(h))
        return Box(*(whole(v / s * 1000) for v, s in ((self.x1, w), (self.y1, h), (self.x2, w), (self.y2, h))))

    def from_per_mille(self, w, h) -> Box:
        return Box(*(whole(v / F.lit(1000.0) * s) for v, s in ((self.x1, F.lit(w)), (self.y1, F.lit(h)), (self.x2, F.lit(w)), (self.y2, F.lit(h)))))

    def padded(self, w, h, ratio: float, least: int) -> Box:
        """For a crop: grown by a share of the short side, or by `least` if that is more, and clipped."""
        pad = F.greatest(F.lit(least), whole(F.least(self.width, self.height) * ratio))
        return Box(self.x1 - pad, self.y1 - pad, self.x2 + pad, self.y2 + pad).clip(w, h)

    # shapes, relative to a page of w x h

    def wr(self, w) -> Column:
        return F.greatest(F.lit(1), self.width) / F.greatest(F.lit(1), F.lit(w)).cast("double")

    def hr(self, h) -> Column:
        return F.greatest(F.lit(1), self.height) / F.greatest(F.lit(1), F.lit(h)).cast("double")

    def ar(self, w, h) -> Column:
        return self.area() / F.greatest(F.lit(1), F.lit(w) * F.lit(h)).cast("double")

    def either_band(self, w, h, span: float, other: float, strict: bool = False) -> Column:
        """Long on one axis and thin on the other."""
        wr, hr = self.wr(w), self.hr(h)
        if strict:
            return ((wr > span) & (hr < other)) | ((hr > span) & (wr < other))
        return ((wr >= span) & (hr <= other)) | ((hr >= span) & (wr <= other))

    def is_full_width_band(self, w, h) -> Column:
        return self.either_band(w, h, 0.9, 0.45) & (self.ar(w, h) >= 0.18)

    def is_band_like(self, w, h) -> Column:
        bw, bh = F.greatest(F.lit(1), self.width), F.greatest(F.lit(1), self.height)
        return self.either_band(w, h, 0.92, 0.42) & (bw * bh / F.greatest(F.lit(1), F.lit(w) * F.lit(h)).cast("double") >= 0.15)

    def is_strip(self, w, h, span: float = 0.9, other: float = 0.38) -> Column:
        return self.either_band(w, h, span, other, strict=True)

    def is_full_page(self, w, h) -> Column:
        return (self.wr(w) >= 0.97) & (self.hr(h) >= 0.97)

    def edge_touches(self, w, h, tol: int = 2) -> Column:
        flags = (self.x1 <= tol, self.y1 <= tol, self.x2 >= F.lit(w) - tol, self.y2 >= F.lit(h) - tol)
        return sum((f.cast("int") for f in flags), F.lit(0))

    def side(self, w) -> Column:
        return F.when(self.cx <= F.lit(w) / 2.0, "left").otherwise("right")

    def side_coverage(self, w, h) -> Column:
        half = F.greatest(F.lit(1.0), F.lit(w) / 2.0) * F.greatest(F.lit(1), F.lit(h)).cast("double")
        return self.area() / F.greatest(F.lit(1.0), half)


def axis_gap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.greatest(F.lit(0), b1 - a2, a1 - b2)


def cross_overlap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    shared = F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1))
    return shared / F.greatest(F.lit(1), F.least(a2 - a1, b2 - b1)).cast("double")


def union_of() -> list[Column]:
    """Aggregates for the box around a group."""
    return [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]


def is_spread(w: Column, h: Column) -> Column:
    return w / F.greatest(F.lit(1), h).cast("double") >= 1.35


def odd_kernel(size: Column) -> Column:
    size = F.greatest(F.lit(1), size)
    return F.when(size % 2 == 0, size + 1).otherwise(size)


def kernel_of(w, h, ratio: float, least: int = 1) -> Column:
    """An odd kernel that is a share of the short side."""
    return odd_kernel(F.greatest(F.lit(least), whole(F.least(F.lit(w), F.lit(h)) * ratio)))


def grid_cells(box: Box, w: int, h: int, rows: int = 2, cols: int = 2) -> Column:
    """An array of rows x cols cells of the box, padded by half a per cent of the page's short side; the last ones end with the box."""
    pad = max(4, round(min(w, h) * 0.005))
    cw, ch = F.floor(box.width / cols), F.floor(box.height / rows)

    def cell(r: Column) -> Column:
        def one(c: Column) -> Column:
            x1, y1 = box.x1 + c * cw, box.y1 + r * ch
            x2 = F.when(c < cols - 1, box.x1 + (c + 1) * cw).otherwise(box.x2)
            y2 = F.when(r < rows - 1, box.y1 + (r + 1) * ch).otherwise(box.y2)
            return F.struct(r.alias("r"), c.alias("c"), Box(x1 - pad, y1 - pad, x2 + pad, y2 + pad).clip(w, h).struct().alias("box"))

        return F.transform(F.sequence(F.lit(0), F.lit(cols - 1)), one)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), cell))


def page_number(stem: Column) -> Column:
    """From a stem that ends with _pNNNN; null without one."""
    digits = F.regexp_extract(stem, r"_p(\d{4})$", 1)
    return F.when(digits != "", digits.cast("int"))


#: For the SQL front end: CREATE TEMPORARY FUNCTION bodies over box coordinates.
SQL_FUNCTIONS = {
    "box_area(x1 BIGINT, y1 BIGINT, x2 BIGINT, y2 BIGINT) RETURNS BIGINT": "greatest(0, x2 - x1) * greatest(0, y2 - y1)",
    "box_overlap(a1 BIGINT, a2 BIGINT, b1 BIGINT, b2 BIGINT) RETURNS DOUBLE": "greatest(0, least(a2, b2) - greatest(a1, b1)) / cast(greatest(1, least(a2 - a1, b2 - b1)) AS DOUBLE)",
    "box_gap(a1 BIGINT, a2 BIGINT, b1 BIGINT, b2 BIGINT) RETURNS BIGINT": "greatest(0, b1 - a2, a1 - b2)",
}
