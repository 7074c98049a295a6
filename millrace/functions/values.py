"""Checks and normal forms of single values, as Columns. `checked` values are struct<value, error>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+$"
UNITS = ["b", "Kb", "Mb", "Gb", "Tb", "Pb"]
#: Country calling codes of the regions whose national numbers can be given, trunk prefix, and lengths of
#: the national significant number. A subset of the public numbering plan.
CALLING = {"AU": ("61", "0", 9, 9), "NZ": ("64", "0", 8, 10), "GB": ("44", "0", 9, 10), "US": ("1", "1", 10, 10), "CA": ("1", "1", 10, 10), "FR": ("33", "0", 9, 9), "DE": ("49", "0", 6, 11), "ES": ("34", "", 9, 9), "IN": ("91", "0", 10, 10), "SG": ("65", "", 8, 8)}


def checked(value: Column, ok: Column, message: str) -> Column:
    """The value where it holds, else the error; null stays null without an error."""
    good = F.coalesce(ok, F.lit(False))
    return F.struct(F.when(good, value).alias("value"), F.when(value.isNotNull() & ~good, F.lit(message)).alias("error"))


def digits(value: Column) -> Column:
    return checked(value, value.rlike("^[0-9]*$"), "not all digits")


def email(value: Column) -> Column:
    return checked(value, value.rlike(EMAIL), "not an email address")


def gender(value: Column) -> Column:
    upper = F.upper(value)
    return checked(upper, upper.isin("M", "F"), "not a gender")


def one_of(value: Column, allowed: list[str]) -> Column:
    return checked(value, value.isin(allowed), "not an allowed value")


def geoloc(value: Column) -> Column:
    """struct<lat, lon> of "lat,lon" within ±90 and ±180."""
    parts = F.split(value, ",")
    lat, lon = F.trim(F.try_element_at(parts, F.lit(1))).try_cast("double"), F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
    ok = (F.size(parts) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    point = F.when(value.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))
    return checked(point, ok, "not a latitude and longitude")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371.0087714 km."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * 6371.0087714 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def title_case(word: Column) -> Column:
    return F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substring(word, 2, 1 << 30)))


def given_names(names: Column) -> Column:
    """Title Case words, cut at punctuation and space."""
    words = F.filter(F.split(names, r"[\p{Punct}\s]+"), lambda w: w != "")
    return F.array_join(F.transform(words, title_case), " ")


def surname(name: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(name, r"[^\p{L}\p{N}_]+", " ")))


def person_name(given: Column, family: Column, unknown: Column) -> Column:
    """A person's label from given and family names, or from a name of unknown order; both is an error, as is none."""
    known = F.coalesce(given, family).isNotNull()
    label = F.nullif(F.trim(F.concat_ws(" ", F.nullif(given_names(given), F.lit("")), F.nullif(surname(family), F.lit("")))), F.lit(""))
    plain = F.nullif(surname(unknown), F.lit(""))
    error = F.when(known & unknown.isNotNull(), "known and unknown names together").when(F.coalesce(label, plain).isNull(), "no name")
    return F.struct(F.when(error.isNull(), F.coalesce(label, plain)).alias("value"), error.alias("error"))


def person_attributes(given: Column, family: Column) -> Column:
    """The attributes that a person's known names give: givennames and surname in lower case; those that are blank are
    left out."""
    pairs = F.array(F.struct(F.lit("givennames").alias("k"), F.lower(F.trim(given)).alias("v")), F.struct(F.lit("surname").alias("k"), F.lower(F.trim(surname(family))).alias("v")))
    return F.map_from_entries(F.transform(F.filter(pairs, lambda p: p["v"].isNotNull() & (p["v"] != "")), lambda p: F.struct(p["k"].alias("k"), F.array(p["v"]).alias("v"))))


def phone_e164(value: Column) -> Column:
    """Digits of the international number of `REGION:number` or `+number`; for the regions listed in CALLING."""
    region = F.upper(F.regexp_extract(value, r"^([A-Za-z]{2}):", 1))
    raw = F.regexp_replace(F.regexp_replace(value, r"^[A-Za-z]{2}:", ""), r"[\s().-]", "")
    national, whole = F.lit(None).cast("string"), F.regexp_extract(raw, r"^\+([0-9]{7,15})$", 1)
    good = F.lit(False)
    for code, (prefix, trunk, low, high) in CALLING.items():
        bare = F.regexp_replace(raw, f"^{trunk}", "") if trunk else raw
        fits = bare.rlike(f"^[0-9]{{{low},{high}}}$")
        national = F.when((region == code) & fits, F.concat(F.lit(prefix), bare)).otherwise(national)
        good = good | (whole.rlike(f"^{prefix}[0-9]{{{low},{high}}}$"))
    number = F.when(region != "", national).otherwise(F.when(good, whole))
    return F.struct(number.alias("value"), F.when(value.isNotNull() & number.isNull(), "not a telephone number").alias("error"))


def address_clean(value: Column) -> Column:
    """Runs of spaces and of commas made one; no commas or spaces at the end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\s+", " "), r"(?:\s*,)+", ","), r"[,\s]+$", "")


def strip_quotes(value: Column) -> Column:
    """Without one pair of matching quotes around it."""
    first, last = F.left(value, F.lit(1)), F.right(value, F.lit(1))
    paired = (F.length(value) >= 2) & (first == last) & first.isin("'", '"')
    return F.when(paired, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def blank_to_null(value: Column) -> Column:
    """Null where nothing is left without white space and quotes around it; the value itself is not changed."""
    return F.when(F.regexp_replace(value, r"""^[\s'"]+|[\s'"]+$""", "") != "", value)


def human_size(size: Column) -> Column:
    """Bytes in the largest unit, in steps of 1024, of which there is more than half a one; one decimal, halves up."""
    tenth = lambda x: F.format_string("%.1f", F.floor(x * 10 + 0.5) / 10.0)
    out = F.concat(tenth(size.cast("double")), F.lit(UNITS[0]))
    for n, unit in enumerate(UNITS[1:], 1):
        scaled = size / float(1024**n)
        out = F.when(scaled > 0.5, F.concat(tenth(scaled), F.lit(unit))).otherwise(out)
    return out


def short_marking(value: Column) -> Column:
    """Upper case, trimmed, under 32 characters, else an error."""
    clean = F.upper(F.trim(value))
    return checked(clean, F.length(clean) < 32, "32 characters or more")


def permission_values(values: Column) -> Column:
    return F.transform(values, lambda v: F.upper(F.trim(v)))


def day_first_date(value: Column) -> Column:
    return F.try_to_timestamp(value, F.lit("dd/MM/yyyy"))
