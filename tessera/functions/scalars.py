"""Scalar expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The raw input sources and the place of each one's object below a tile's folder.
ARD_SOURCES = {
    "dem": "misc/dem_{tag}.hkl",
    "s1": "s1/{tag}.hkl",
    "s2_10": "s2_10/{tag}.hkl",
    "s2_20": "s2_20/{tag}.hkl",
    "s2_dates": "misc/s2_dates_{tag}.hkl",
    "clouds": "clouds/clouds_{tag}.hkl",
}
TOKEN = r"^\s*(-?\d+)X(-?\d+)Y\s*$"
EARTH_RADIUS = 6378137.0


def token_x(token: Column) -> Column:
    return F.regexp_extract(token, TOKEN, 1).try_cast("int")


def token_y(token: Column) -> Column:
    return F.regexp_extract(token, TOKEN, 2).try_cast("int")


def tile_tag(x: Column, y: Column) -> Column:
    return F.concat(x.cast("string"), F.lit("X"), y.cast("string"), F.lit("Y"))


def source_key(source: str, year: Column, x: Column, y: Column) -> Column:
    """The object key of one raw source of a tile-year."""
    before, after = ARD_SOURCES[source].split("{tag}")
    s = lambda c: c.cast("string")
    return F.concat(s(year), F.lit("/raw/"), s(x), F.lit("/"), s(y), F.lit("/raw/" + before), tile_tag(x, y), F.lit(after))


def prediction_key(year: Column, x: Column, y: Column, ending: str = "tif") -> Column:
    s = lambda c: c.cast("string")
    return F.concat(s(year), F.lit("/tiles/"), s(x), F.lit("/"), s(y), F.lit("/"), tile_tag(x, y), F.lit(f"_FINAL.{ending}"))


def legacy_ordinal(date: Column, year: Column | int) -> Column:
    """A day number that knows no leap days: 365 for each year from `year`, then fixed month starts."""
    starts = [0]
    for days in (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30):
        starts.append(starts[-1] + days)
    first = F.element_at(F.array(*map(F.lit, starts)), F.month(date))
    return (F.year(date) - (F.lit(year) if isinstance(year, int) else year)) * 365 + first + F.dayofmonth(date)


def mercator_x(lon: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high)))


def quantise(x: Column) -> Column:
    """[0, 1] to 16 bits, halves to even, what lies outside to the nearest end."""
    return clip(F.bround(x * 65535), 0, 65535).cast("int")


def radar_db(x: Column) -> Column:
    """Backscatter to decibels from -22 up, scaled to [0, 1]."""
    return clip((F.greatest(10 * F.log10(x + 1 / 65535), F.lit(-22.0)) + 22) / 22, 0, 1)


def small_float(text: Column) -> Column:
    """A number from text; null for what isn't one, and for NaN."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def invocation_cost(n: Column, seconds: Column, mb: Column, price: float = 0.00001667) -> Column:
    """Serverless cost: invocations x seconds x GB x price of a GB-second."""
    return n * seconds * (mb / 1024) * price


#: Half a tile's side in degrees.
HALF_TILE = 1 / 36


def box_around(x: Column, y: Column, half: float | Column) -> Column:
    """struct(w, s, e, n): what lies within `half` of a point."""
    return F.struct((x - half).alias("w"), (y - half).alias("s"), (x + half).alias("e"), (y + half).alias("n"))


def tile_box(lon: Column, lat: Column) -> Column:
    """The box of the tile around a centre."""
    return box_around(lon, lat, HALF_TILE)


def expanded(box: Column, n: float) -> Column:
    """A box grown by n 360ths of a degree on all sides."""
    by = n / 360
    return F.struct((box["w"] - by).alias("w"), (box["s"] - by).alias("s"), (box["e"] + by).alias("e"), (box["n"] + by).alias("n"))


def ring(box: Column) -> Column:
    """A box's corners against the clock, the first again at the end, as [x, y] pairs."""
    return F.array(*[F.array(box[x], box[y]) for x, y in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"), ("w", "s"))])


def longitude(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS)


def latitude(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(1.5707963267948966))


def buffered(box: Column, metres: float) -> Column:
    """A box in degrees grown by metres of the Mercator projection on all sides."""
    return F.struct(
        longitude(mercator_x(box["w"]) - metres).alias("w"), latitude(mercator_y(box["s"]) - metres).alias("s"),
        longitude(mercator_x(box["e"]) + metres).alias("e"), latitude(mercator_y(box["n"]) + metres).alias("n"),
    )


def day_in(date: Column, year: int) -> Column:
    """The day of the year, null for dates of other years."""
    return F.when(F.year(date) == year, F.dayofyear(date))


def reflectance(dn: Column) -> Column:
    """A digital number to [0, 1]."""
    return clip(dn / 10000.0, 0, 1)


def cloud_byte(share: Column) -> Column:
    """A share of cloud times 255; null over 100."""
    return F.when(share * 255 <= 100, share * 255)
