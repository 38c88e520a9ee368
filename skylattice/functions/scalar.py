"""Column expressions: wind, thermodynamics, dates, text and arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the published formulas.
LATENT_HEAT_VAPORISATION = 2.501e6
LATENT_HEAT_FREEZING = 2.834e6
HEAT_CAPACITY_AIR = 1005.0
TEMPERATURE_RANGE_K = (140.0, 320.0)
MAX_SPECIFIC_HUMIDITY = 0.025
MAX_PRESSURE_PA = 106000.0
TYPICAL_VERTICAL_WIND = 0.1
FIRST_CALM_LEVEL = 51
MAX_MASS_FLUX = 3.0
MAX_CONDENSATE = 1.0e-4
MAX_RATE = {"stratiform_rain": 3.0e-4, "stratiform_snow": 2.0e-4, "convective_rain": 1.0e-3, "convective_snow": 3.0e-4}


def wind_u(direction: Column, speed: Column) -> Column:
    return F.sin(F.radians(direction)) * speed


def wind_v(direction: Column, speed: Column) -> Column:
    return F.cos(F.radians(direction)) * speed


def wind_components(suffixes: Sequence[str], speed: str = "windspd_{}", direction: str = "winddir_{}") -> list[Column]:
    """u and v columns for every level suffix, as one select list."""
    out = []
    for s in suffixes:
        d, v = F.col(direction.format(s)), F.col(speed.format(s))
        out += [wind_u(d, v).alias(f"u_wind_{s}"), wind_v(d, v).alias(f"v_wind_{s}")]
    return out


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    """Sine and cosine of the hour with hour 23 at pi, as the features are
    defined (half a turn a day, not a whole one)."""
    angle = hour / F.lit(23.0) * F.pi()
    return F.sin(angle), F.cos(angle)


def virtual_potential_temperature(t: Column, q: Column, theta: Column) -> Column:
    return F.try_divide((t + F.lit(0.6) * q) * theta, t)


def total_water(*parts: Column) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def liquid_ice_theta(t: Column, theta: Column, liquid: Column, rain: Column, ice: Column, graupel: Column) -> Column:
    """Liquid-ice temperature times theta / T."""
    lv = LATENT_HEAT_VAPORISATION / HEAT_CAPACITY_AIR
    lf = LATENT_HEAT_FREEZING / HEAT_CAPACITY_AIR
    return (t - F.lit(lv) * (liquid + rain) - F.lit(lf) * (ice + graupel)) * F.try_divide(theta, t)


def scaled_temperature(t: Column) -> Column:
    lo, hi = TEMPERATURE_RANGE_K
    return (t - F.lit(lo)) / F.lit(hi - lo)


def scaled_humidity(q: Column) -> Column:
    return q / F.lit(MAX_SPECIFIC_HUMIDITY)


def scaled_pressure(p: Column) -> Column:
    return p / F.lit(MAX_PRESSURE_PA)


def clipped(value: Column, low: float, high: float) -> Column:
    """The value, held between both ends; null and NaN stay what they are."""
    held = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNull() | F.isnan(value.cast("double")), value).otherwise(held)


def scaled_vertical_wind(w: Column, level: Column) -> Column:
    """In units of a typical wind, between -1 and 1; zero in the calm levels on
    top, whatever the wind there."""
    scaled = clipped(w / F.lit(TYPICAL_VERTICAL_WIND), -1.0, 1.0)
    return F.when(level >= FIRST_CALM_LEVEL, F.lit(0.0)).otherwise(scaled)


def scaled_mass_flux(flux: Column) -> Column:
    """Share of the greatest flux, between 0 and 1."""
    return clipped(flux / F.lit(MAX_MASS_FLUX), 0.0, 1.0)


def scaled_condensate(q: Column) -> Column:
    """Liquid or ice water."""
    return q / F.lit(MAX_CONDENSATE)


def scaled_rate(rate: Column, kind: str) -> Column:
    """Precipitation of one kind, each by a rate of its own."""
    return rate / F.lit(MAX_RATE[kind])


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "djf")
        .when(month.isin(3, 4, 5), "mam")
        .when(month.isin(6, 7, 8), "jja")
        .when(month.isin(9, 10, 11), "son")
    )


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def days_since(ts: Column, origin: str) -> Column:
    """Whole days from ``origin`` to the date."""
    return F.datediff(F.to_date(ts), F.lit(origin).cast("date"))


def date_of_days(days: Column, origin: str) -> Column:
    return F.date_add(F.lit(origin).cast("date"), days.cast("int"))


def split_label(label: Column, sep: str = "_") -> tuple[Column, Column]:
    """Image and label of ``image<sep>label``; any other number of parts is
    an error while the job runs."""
    parts = F.split(label, f"\\Q{sep}\\E")
    bad = F.raise_error(F.concat(F.lit("expected two parts in "), label))
    image = F.when(label.isNull() | (F.size(parts) == 2), parts[0]).otherwise(bad.cast("string"))
    return image, parts[1]


def within_centres(x: Column, y: Column, centres: Sequence[tuple[float, float]], radius: float) -> list[Column]:
    """1 where the point lies closer than ``radius`` to a centre, else 0."""
    return [
        (F.sqrt((x - F.lit(cx)) ** 2 + (y - F.lit(cy)) ** 2) < F.lit(radius)).cast("int")
        for cx, cy in centres
    ]


def array_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def array_multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def array_scale(a: Column, factor: Column | float) -> Column:
    return F.transform(a, lambda x: x * factor)


def correlation(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation as an aggregate; null, not an error, where either
    side is constant."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def keyed_number(*ids: str | Column, seed: int = 0) -> Column:
    """A repeatable whole number below 2^60 from ids and a seed: the first 15
    hex digits of an md5, which any engine can compute again."""
    parts = [(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``. A column named
    inside an array lambda would be evaluated again for every element."""
    return F.transform(F.array(value), body)[0]


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def run_lengths(encoded: Column) -> Column:
    """``"start length start length ..."`` to an array of (start, length)."""
    tokens = F.split(F.trim(encoded), "\\s+")
    pairs = F.sequence(F.lit(0), (F.floor(F.size(tokens) / 2) - 1).cast("int"))
    return F.when(
        F.size(tokens) >= 2,
        F.transform(
            pairs,
            lambda i: F.struct(
                F.element_at(tokens, i * 2 + 1).cast("long").alias("start"),
                F.element_at(tokens, i * 2 + 2).cast("long").alias("length"),
            ),
        ),
    )
