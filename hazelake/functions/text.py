"""Text scalars (P1, P5–P10, P14, P16) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazelake import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def falsy_coalesce(*cols) -> Column:
    """`a or b` — empty strings count as missing."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_param(raw, display=None) -> Column:
    """lower/strip, drop ' mass' and ' concentration', '_' and '.' to blanks, alias map,
    else remove blanks and dots."""
    src = falsy_coalesce(raw, display) if display is not None else falsy_coalesce(raw)
    t = F.lower(_strip(F.coalesce(src, F.lit(""))))
    t = F.replace(F.replace(t, F.lit(" mass"), F.lit("")), F.lit(" concentration"), F.lit(""))
    t = _strip(F.translate(t, "_.", "  "))
    expr = None
    for names, canon in K.PARAM_ALIASES:
        cond = t.isin(names)
        expr = F.when(cond, canon) if expr is None else expr.when(cond, canon)
    return expr.otherwise(F.translate(t, " .", ""))


def _map(d: dict) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def pollutant_code(code) -> Column:
    """P5: code -> parameter, unknown -> itself."""
    c = _c(code)
    return F.coalesce(F.element_at(_map(K.POLLUTANT_CODES), c), c)


def pollutant_display(code) -> Column:
    """P5: code -> display name, unknown -> upper-cased code."""
    c = _c(code)
    return F.coalesce(F.element_at(_map(K.POLLUTANT_DISPLAY), c), F.upper(c))


def country_code(name) -> Column:
    """Known names mapped, else first two letters upper-cased."""
    n = _c(name)
    return F.coalesce(F.element_at(_map(K.COUNTRY_CODES), n), F.upper(F.substring(n, 1, 2)))


def location_slug(city, state) -> Column:
    """iqair_<city>_<state>, lower-cased, blanks to underscores."""
    return F.replace(F.lower(F.concat(F.lit("iqair_"), _c(city), F.lit("_"), _c(state))),
                     F.lit(" "), F.lit("_"))


def location_display(city, state) -> Column:
    return F.concat_ws(", ", _c(city), _c(state))


def sensor_text(sensors) -> Column:
    """One bullet line per sensor, newline-joined; a fixed text when there is none."""
    s = _c(sensors)
    line = F.transform(s, lambda x: F.concat(
        F.lit("    • "), F.coalesce(x["parameter_display"], x["parameter"], F.lit("N/A")),
        F.lit(": "), F.coalesce(x["latest_value"].cast("string"), F.lit("None")),
        F.lit(" "), F.coalesce(x["unit"], F.lit("")),
        F.when(F.coalesce(x["latest_datetime"], F.lit("")) != "",
               F.concat(F.lit(" (Cập nhật: "), x["latest_datetime"], F.lit(")"))).otherwise(F.lit(""))))
    return F.when(F.coalesce(F.size(s), F.lit(0)) <= 0, F.lit("    Không có dữ liệu sensors")) \
            .otherwise(F.array_join(line, "\n"))


def alert_subject(location_name, aqi_value, main_pollutant) -> Column:
    """P10: subject line; the main-pollutant part vanishes when it is empty."""
    mp = F.nullif(_c(main_pollutant), F.lit(""))
    main = F.when(mp.isNotNull(), F.concat(F.lit(" - Chất ô nhiễm chính: "), mp)).otherwise(F.lit(""))
    return F.concat(F.lit("[CẢNH BÁO AQI] "), F.coalesce(_c(location_name).cast("string"), F.lit("None")),
                    F.lit(" vượt ngưỡng (AQI="), _c(aqi_value).cast("double").cast("string"), main, F.lit(")"))


def summary_subject(count, location_name, max_aqi, main_pollutant) -> Column:
    """P10: subject of a station's alerts together; one alert has the short form."""
    name = F.coalesce(_c(location_name).cast("string"), F.lit("None"))
    mp = F.nullif(_c(main_pollutant), F.lit(""))
    main = F.when(mp.isNotNull(), F.concat(F.lit(", Main: "), mp)).otherwise(F.lit(""))
    highest = _c(max_aqi).cast("double").cast("string")
    return F.when(_c(count) > 1, F.concat(F.lit("[CẢNH BÁO AQI] "), _c(count).cast("string"), F.lit(" bản ghi vượt ngưỡng tại "), name,
                                          F.lit(" (AQI cao nhất: "), highest, main, F.lit(")"))) \
            .otherwise(F.concat(F.lit("[CẢNH BÁO AQI] "), name, F.lit(" vượt ngưỡng (AQI="), highest, main, F.lit(")")))


def alert_body(place, aqi, level, parameter, value, unit, threshold, measured) -> Column:
    """P10: plain text of one alert."""
    def number(c):
        return _c(c).cast("double").cast("string")
    u = F.coalesce(_c(unit), F.lit(""))
    return F.concat(F.lit("CẢNH BÁO AQI tại "), _c(place), F.lit(": AQI="), number(aqi), F.lit(", mức "), _c(level), F.lit(". Giá trị "), _c(parameter),
                    F.lit(" = "), number(value), F.lit(" "), u, F.lit(", vượt ngưỡng "), number(threshold), F.lit(" "), u, F.lit(". Thời điểm đo: "),
                    F.date_format(measured, "yyyy-MM-dd HH:mm:ss 'UTC'"))


def location_info(name, locality, country) -> Column:
    """P10: 'name[, locality][, country]' with empty parts left out."""
    return F.concat_ws(", ", _c(name), F.nullif(_c(locality), F.lit("")), F.nullif(_c(country), F.lit("")))


EMAIL_PATTERN = r"^[^@]*@[^@]*\."


def email_valid(e) -> Column:
    """Non-empty, has '@', and a '.' between the first and the second '@'."""
    t = _strip(_c(e))
    return (t != "") & t.rlike(EMAIL_PATTERN)


def ci_equals(c, value: str, max_variants: int = 16) -> Column:
    """Case-insensitive equality that Parquet can push down: when the value has few letters,
    an IN list of its case variants (pushable) guards the exact lower() test."""
    import itertools
    col = _c(c)
    exact = F.lower(col) == value.lower()
    letters = [ch for ch in value if ch.isalpha()]
    if 2 ** len(letters) > max_variants:
        return exact
    choices = [(ch.lower(), ch.upper()) if ch.isalpha() else (ch,) for ch in value.lower()]
    variants = sorted({"".join(p) for p in itertools.product(*choices)})
    return col.isin(variants) & exact
