"""Text functions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words; month names.
STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
MONTHS = "January February March April May June July August September October November December".split()


def _month(name: str) -> str:
    """A month's name or its first three letters; the first letter in either case, but for May, as `may` is a verb."""
    first = name[0] if name == "May" else f"[{name[0]}{name[0].lower()}]"
    return f"{first}{name[1:3]}" + (f"(?:{name[3:]})?" if name[3:] else "")


#: What follows an expression: the end, white space, a full stop or a comma; after a year also a dash or a slash.
_ENDS, _YEAR_ENDS, _ERA = r"(?![^\s.,])", r"(?![^\s.,/-])", r"(?:BC|AC|B\.C\.|A\.C\.)"
TIME_PATTERNS = {
    "day": rf"[0-3]?\d[-.][0-3]?\d[-.](?:\d{{2}})?\d{{2}}{_ENDS}",
    "month": rf"(?:{'|'.join(map(_month, MONTHS))}){_ENDS}",
    "clock": rf"(?:2[0-3]|[01]?\d):[0-5]?\d(?::[0-5]?\d)?\s?(?:[AP]M|[Hh])?{_ENDS}",
    "year": rf"(?:[12]\d{{3}}(?:\s?{_ERA})?|\d{{1,3}}\s?{_ERA}){_YEAR_ENDS}",
    "o_clock": rf"(?:1?\d|2?[0-4])\s?[Oo]['`][Cc]lock{_ENDS}",
}
_ACCENTED, _PLAIN = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy"
MAX_TOKEN = 255


def fold(text: Column) -> Column:
    """Latin letters without their accents; ß and the ligatures as two letters."""
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.translate(text, _ACCENTED, _PLAIN)


#: A term, and the 's at its end.
_TERM = r"[\p{L}\p{N}]+(?:['.][\p{L}\p{N}]+)*"
_POSSESSIVE = r"(?<=[\p{L}\p{N}])'s(?![\p{L}\p{N}])(?!['.][\p{L}\p{N}])"


def terms(text: Column) -> Column:
    """Array of terms: runs of letters and digits, with apostrophes and dots inside, lower case, folded, without 's, stop words and overlong ones.

    All but the last is done to the text as a whole, which is much cheaper than to each term.
    """
    low = F.lower(text)
    bare = F.when(low.contains("'s"), F.regexp_replace(low, _POSSESSIVE, "")).otherwise(low)
    plain = F.when(F.octet_length(low) > F.length(low), fold(bare)).otherwise(bare)  # ASCII has nothing to fold
    return F.filter(F.regexp_extract_all(plain, F.lit(_TERM), F.lit(0)), lambda t: (F.length(t) <= MAX_TOKEN) & ~t.isin(*STOP_WORDS))


def term_set(text: Column) -> Column:
    return F.array_distinct(terms(text))


def has_time_expression(text: Column) -> Column:
    """True if any of TIME_PATTERNS is in the text; null counts as empty."""
    return F.coalesce(F.greatest(*(text.rlike(p) for p in TIME_PATTERNS.values())), F.lit(False))


def human_bytes(n: Column, si: bool = False) -> Column:
    """A count of bytes for people, with one decimal: 1.5 KiB, or 1.5 kB with si."""
    unit, names = (1000, "kMGTPE") if si else (1024, "KMGTPE")
    out = F.concat(n.cast("string"), F.lit(" B"))
    for k in range(1, 7):
        out = F.when(n >= unit**k, F.format_string(f"%.1f {names[k - 1]}{'' if si else 'i'}B", n / float(unit**k))).otherwise(out) if unit**k < 2**63 else out
    return out


def shorten(text: Column, most: int = 100) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(" ..."))).otherwise(text)
