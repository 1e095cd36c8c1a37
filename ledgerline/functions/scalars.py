"""Column functions: ids, seasons, names, numbers, dates and display formats."""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

DASH = "—"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ids and seasons -----------------------------------------------------------------


def era(game_id: Column | str, strict: bool = False) -> Column:
    """The id scheme, from the id's shape alone; strict also asks for digits only."""
    g = col(game_id)
    own = (F.length(g) == 10) & g.startswith("00")
    return F.when(own & g.rlike("^[0-9]+$") if strict else own, "nba").otherwise("espn")


def season_start(season: Column | str) -> Column:
    return F.substring(col(season), 1, 4).try_cast("int")


def season_label(year: Column) -> Column:
    """2015 -> '2015-16'."""
    return F.format_string("%d-%02d", year, F.pmod(year + 1, F.lit(100)))


def kind(season_type: Column | str) -> Column:
    """PO, PI, and RS for everything else."""
    t = col(season_type)
    return F.when(t == "Playoffs", "PO").when(t == "Play-In", "PI").otherwise("RS")


def id_season(game_id: Column | str) -> Column:
    """Start year from digits 4 and 5 of an id; two-digit years from 46 are of the 1900s."""
    yy = F.substring(col(game_id), 4, 2)
    n = F.when(yy.rlike("^[0-9]{2}$"), yy.cast("int"))
    return F.when(n >= 46, n + 1900).otherwise(n + 2000)


def id_season_type(game_id: Column | str, part: int = 1) -> Column:
    """Season type (part 1) or its suffix (part 0) from digit 3 of an id."""
    d = F.substring(col(game_id), 3, 1)
    out = F.lit("Unknown" if part else "??")
    for digit, names in (S.SEASON_TYPES | {"1": ("PRE", "Pre Season"), "3": ("AS", "All-Star")}).items():
        out = F.when(d == digit, names[part]).otherwise(out)
    return out


def season_normal(season: Column | str, fallback: Column | None = None) -> Column:
    """'2023' and '22023' -> '2023-24'; a blank gives the fallback."""
    s = F.nullif(F.trim(col(season)), F.lit(""))
    out = F.when(s.rlike("^[0-9]{4}$"), season_label(s.try_cast("int"))).when(s.rlike("^[2-5][0-9]{4}$"),
        season_label(F.substring(s, 2, 4).try_cast("int"))).otherwise(s)
    return out if fallback is None else F.coalesce(out, fallback)


def clean_id(x: Column | str, width: int | None = None) -> Column:
    """Trimmed, without a trailing '.0'; words for null become ''; padded with zeros to width
    (never cut, and '' stays)."""
    s = F.regexp_replace(F.trim(col(x).cast("string")), r"\.0$", "")
    s = F.when(s.isNull() | s.isin("<NA>", "nan", "None"), "").otherwise(s)
    return s if width is None else F.when((s != "") & (F.length(s) < width), F.lpad(s, width, "0")).otherwise(s)


def number_id(x: Column | str) -> Column:
    """'1018.0' -> '1018'; null if it isn't a number."""
    return col(x).try_cast("double").try_cast("bigint").cast("string")


def tricode(abbr: Column | str) -> Column:
    """A team code in its one spelling; codes unknown to the alias map pass through."""
    a = F.upper(F.trim(col(abbr)))
    names = F.create_map(*[F.lit(x) for x in chain(*S.ALIASES.items())])
    return F.coalesce(F.try_element_at(names, a), a, F.lit(""))


def team_name(code: Column | str) -> Column:
    names = F.create_map(*[F.lit(x) for x in chain(*S.TEAM_NAMES.items())])
    return F.coalesce(F.try_element_at(names, F.upper(F.trim(col(code)))), col(code), F.lit(""))


def is_allowed_team(code: Column | str) -> Column:
    return F.coalesce(col(code).isin(*S.TEAM_NAMES), F.lit(False))


# names ---------------------------------------------------------------------------


@functools.cache
def _folds() -> tuple[str, str, str]:
    """What compatibility decomposition leaves of letters outside ASCII, from Unicode's own tables:
    letters that become one ASCII letter, these letters, and, as JSON, those that become several."""
    one, several = {}, {}
    for code in range(128, sys.maxunicode + 1):
        left = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if left:
            (one if len(left) == 1 else several)[chr(code)] = left
    return "".join(one), "".join(one.values()), json.dumps(several)


def without_accents(name: Column | str) -> Column:
    """ASCII letters only: accents go, and so do letters that have no ASCII base. All in the JVM;
    only names that hold such letters are taken apart."""
    n = col(name)
    marked, plain, several = _folds()
    one = F.translate(n, marked, plain)
    table = F.from_json(F.lit(several), "map<string,string>")
    rest = F.transform(F.regexp_extract_all(one, F.lit("(?s)(.)"), F.lit(1)),
        lambda c: F.when(c.rlike("^[\\x00-\\x7F]$"), c).otherwise(F.coalesce(F.try_element_at(table, c), F.lit(""))))
    foreign = "[^\\x00-\\x7F]"
    return F.when(~n.rlike(foreign), n).when(~one.rlike(foreign), one).otherwise(F.array_join(rest, ""))


def name_key(name: Column | str, keep_suffixes: bool, fold: bool = True) -> Column:
    """A name as lower-case words joined by '-'. Full stops part words and apostrophes don't.
    Officials lose suffix words wherever they stand; players keep them."""
    s = F.lower(without_accents(name) if fold else col(name))
    s = F.regexp_replace(F.replace(F.replace(s, F.lit("."), F.lit(" ")), F.lit("'"), F.lit("")), r"[^a-z0-9\s-]|-", " ")
    words = F.filter(F.split(s, r"\s+"), lambda t: (t != "") if keep_suffixes else (t != "") & ~t.isin(*S.NAME_SUFFIXES))
    return F.array_join(words, "-")


def feed_slug(name: Column | str) -> Column:
    """The feed's own slug: runs of other characters become one '-', none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(name)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def without_initials(key: Column | str) -> Column:
    return F.array_join(F.filter(F.split(col(key), "-"), lambda t: F.length(t) > 1), "-")


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.trim(F.concat_ws(" ", col(first), col(last)))


# numbers -------------------------------------------------------------------------


def number(x: Column | str) -> Column:
    """A double; null where the text isn't a number (or is NaN)."""
    n = col(x).try_cast("double")
    return F.when(~F.isnan(n), n)


def zero_filled(x: Column | str) -> Column:
    return F.coalesce(number(x), F.lit(0.0))


def round2(x: Column) -> Column:
    """Two decimals of the number as it is in binary, ties to even. bround goes by the shortest
    decimal form and times 100 is itself rounded, so either takes 2.675 (just below) for a tie.
    Here x is split into halves whose hundredfold is exact, which tells what times 100 lost."""
    p = x * 100
    wide = x * 134217729.0  # 2 ** 27 + 1
    high = wide - (wide - x)
    lost = (high * 100 - p) + (x - high) * 100
    tie = p - F.floor(p) == 0.5
    up = F.floor(p).cast("double") + 1
    return F.when(tie & (lost != 0), F.when(lost > 0, up).otherwise(up - 1) / 100).otherwise(F.rint(p) / 100)


def made(x: Column | str) -> Column:
    return F.nullif(F.trim(F.split(col(x), "-", 2)[0]), F.lit(""))


def attempted(x: Column | str) -> Column:
    return F.nullif(F.trim(F.get(F.split(col(x), "-", 2), F.lit(1))), F.lit(""))


def home_win(flag: Column | str | None, home: Column, away: Column) -> Column:
    """1 or 0 by the W/L flag, else by points, else null."""
    by_points = F.when(home > away, 1).when(home <= away, 0)
    if flag is None:
        return by_points
    f = F.upper(F.trim(col(flag)))
    return F.coalesce(F.when(f == "W", 1).when(f == "L", 0), by_points)


def heat(x: Column | str) -> Column:
    """The display class of a signed number: 0.5, 1.5, 3 and 5 part the levels."""
    v = col(x)
    level = F.when(F.abs(v) >= 5, 4).when(F.abs(v) >= 3, 3).when(F.abs(v) >= 1.5, 2).when(F.abs(v) >= 0.5, 1).otherwise(0)
    return F.when(v.isNull() | (level == 0),
        "sw s-zero").otherwise(F.concat(F.lit("sw s-"), F.when(v > 0, "pos").otherwise("neg"), F.lit("-"), level.cast("string")))


# dates and display ---------------------------------------------------------------


def moment(x: Column | str) -> Column:
    """The timestamp of an ISO text, null if it is none. Feeds leave the seconds out
    ('2001-11-02T01:00Z'), which Spark alone doesn't read."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(col(x)), r"([T ]\d{1,2}:\d{2})(Z|[+-]\d{2}:?\d{2}|)$", "$1:00$2"))


def iso_date(x: Column | str) -> Column:
    return F.date_format(moment(x), "yyyy-MM-dd")


def utc_date(x: Column | str) -> Column:
    """The UTC calendar day of an ISO time with an offset, as text, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(moment(x), F.current_timezone()), "yyyy-MM-dd")


def html_escaped(x: Column | str) -> Column:
    out = col(x).cast("string")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def thousands(x: Column | str) -> Column:
    return F.coalesce(F.format_number(col(x).cast("bigint"), 0), F.lit(DASH))


def decimal(x: Column | str, places: int = 1) -> Column:
    return F.when(col(x).isNull(), DASH).otherwise(F.format_string(f"%.{places}f", col(x).cast("double")))


def percent(x: Column | str, places: int = 1) -> Column:
    return F.when(col(x).isNull(), DASH).otherwise(F.format_string(f"%.{places}f%%", col(x).cast("double") * 100))


def signed(x: Column | str, places: int = 1) -> Column:
    return F.when(col(x).isNull(), DASH).otherwise(F.format_string(f"%+.{places}f", col(x).cast("double")))


def career_span(first: Column | str, last: Column | str) -> Column:
    """'2015-16' to '2025-26' -> '2015-2026'."""
    return F.concat_ws("-", season_start(first).cast("string"), (season_start(last) + 1).cast("string"))


def in_words(items: Column | str) -> Column:
    """An array as text: 'a', 'a, and b', 'a, b, and c'; null for none."""
    a = col(items)
    n = F.size(a)
    return F.when(n == 1, F.element_at(a, 1)).when(n > 1, F.concat(F.array_join(F.slice(a, F.lit(1), n - 1), ", "), F.lit(", and "), F.element_at(a, -1)))


def subtitle(games: Column | str, first: Column | str, last: Column | str) -> Column:
    return F.concat(thousands(games), F.lit(" g · "), F.when(col(first).isNull(), DASH).otherwise(career_span(first, last)))


def matchup(away: Column | str, home: Column | str) -> Column:
    return F.concat_ws("@", col(away), col(home))


def result(home: Column | str, home_pts: Column | str, away: Column | str, away_pts: Column | str) -> Column:
    whole = lambda x: F.coalesce(col(x).cast("bigint"), F.lit(0))
    return F.format_string("%s %d, %s %d", col(home), whole(home_pts), col(away), whole(away_pts))
