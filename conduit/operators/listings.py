"""Directory-listing lines to listing rows.

Four families of lines are told apart by their first character (and, for one,
a semicolon); each has one pattern, and a line that fails its family's pattern
is no entry. Times are read as UTC epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names as they appear in listings.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_MONTH = "(?i:" + "|".join(MONTHS) + ")"

# Each pattern covers a whole line. Its groups are laid out in one common order, so
# the columns are computed once and not per family; the name comes last.
_PARTS = ("form", "mark", "size", "year", "month", "day", "hour", "minute", "half", "name")

# +facts,<tab>name
FACTS = (
    r"(?s)\A\+([^\t]*)\t(.*)\z",
    {"form": "facts", "mark": "$1", "name": "$2"},
)

# perm nlink [uid] ... size month day time-or-year name; the token before the
# first month name is the size, and that choice is final (atomic group). Tokens that
# no month follows are skipped possessively, which loops and does not go deeper.
UNIX = (
    r"(?s)\A(?>([bcdlps-][^ ]?)[^ ]* +(?:f[^ ]{5} +|[^ ]+ +[^ ]+ +)"
    rf"(?:[^ ]++ ++(?!{_MONTH} ))*+([^ ]++) ++({_MONTH}) +)([0-9]+) +"
    r"(?:([0-9]{1,2}):([0-9]{2})|([0-9]{4,})) (.*)\z",
    {
        "form": "unix", "mark": "$1", "size": "$2", "year": "$7", "month": "$3", "day": "$4",
        "hour": "$5", "minute": "$6", "name": "$8",
    },
)

# name;version blocks day-month-year hour:minute
VERSIONED = (
    r"(?s)\A([^;]*);[^ ]* +[^ ]+ +"
    rf"([0-9]*)-+({_MONTH})-+([0-9]+) +([0-9]+):+([0-9]+)[: ].*\z",
    {
        "form": "versioned", "year": "$4", "month": "$3", "day": "$2",
        "hour": "$5", "minute": "$6", "name": "$1",
    },
)

# month-day-year hour:minute AM|PM <DIR>|size name
DOS = (
    r"(?s)\A([0-9]+)-+([0-9]+)-+([0-9]+) +([0-9]+):+([0-9]+)([AP])M? *"
    r"(?:(<)[^ ]*|([0-9]+)) +([^ ].*)\z",
    {
        "form": "dos", "mark": "$7", "size": "$8", "year": "$3", "month": "$1", "day": "$2",
        "hour": "$4", "minute": "$5", "half": "$6", "name": "$9",
    },
)

# Between the parts of a line while they are one text. A line that holds the mark
# itself has it spelt in two characters meanwhile.
_MARK, _SPELT = "\x01", "\x02"

_DAY = 86400
_GUESS_DAYS = 350  # a date without a year is less than this far in the past


def _laid_out(line: Column, family: tuple[str, dict[str, str]]) -> Column:
    """Array of the common parts of a matching line, from one pass; else NULL."""
    pattern, groups = family
    layout = _MARK.join(groups.get(part, "") for part in _PARTS)
    held = line.contains(_MARK) | line.contains(_SPELT)
    spelt = F.replace(F.replace(line, F.lit(_SPELT), F.lit(f"{_SPELT}b")), F.lit(_MARK), F.lit(f"{_SPELT}a"))
    parts = F.split(F.regexp_replace(F.when(held, spelt).otherwise(line), pattern, layout), _MARK, len(_PARTS))
    return F.when(line.rlike(pattern), parts)


def _unspelt(part: Column) -> Column:
    plain = F.replace(F.replace(part, F.lit(f"{_SPELT}a"), F.lit(_MARK)), F.lit(f"{_SPELT}b"), F.lit(_SPELT))
    return F.when(part.contains(_SPELT), plain).otherwise(part)


def _recognised(line: Column) -> Column:
    """Parts of a line by its family, NULL when it is no entry."""
    head = F.substring(line, 1, 1)
    return F.when(F.length(line) < 2, None).otherwise(
        F.when(head == "+", _laid_out(line, FACTS))
        .when(head.isin("b", "c", "d", "l", "p", "s", "-"), _laid_out(line, UNIX))
        .when(line.contains(";"), _laid_out(line, VERSIONED))
        .otherwise(_laid_out(line, DOS))
    )


def _number(text: Column) -> Column:
    # a failing cast costs an exception per row, so only digits reach it
    return F.when(text.rlike(r"\A0*[0-9]{1,19}\z"), text.try_cast("bigint"))


def _small(text: Column) -> Column:
    """A number of a date: what no calendar has is NULL."""
    return F.when(text.rlike(r"\A0*[0-9]{1,6}\z"), text.cast("int"))


def _day_seconds(year: Column, month: Column, day: Column) -> Column:
    """Epoch seconds of a date; days past the end of the month run over."""
    first = F.try_make_timestamp_ntz(
        year.cast("int"), month.cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )
    days = F.date_diff(first.cast("date"), F.lit("1970-01-01").cast("date"))
    return (days + day - 1).cast("bigint") * _DAY


def _guessed_year(month: Column, day: Column, as_of: Column) -> Column:
    """The first year, from last year on, that is not too long ago."""
    oldest = F.unix_timestamp(as_of) - _GUESS_DAYS * _DAY
    this = F.year(as_of)
    fits = [_day_seconds(this + shift, month, day) > oldest for shift in (-1, 0)]
    return F.when(fits[0], this - 1).when(fits[1], this).otherwise(this + 1)


def _year(shown: Column, two_digits: Column) -> Column:
    century = F.when(shown < 50, shown + 2000).otherwise(shown)
    widened = F.when(century < 1000, century + 1900).otherwise(century)
    return F.when(two_digits, widened).otherwise(shown)


def _fact(facts: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(facts, pattern, 1), F.lit(""))


def parse_listing(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Listing rows of the lines that are entries; the others drop.

    ``as_of`` dates lines without a year.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    # a generator, so the optimiser cannot repeat the match in every column
    found = F.transform(F.array(F.col(f"`{column}`")), _recognised)
    matched = df.select(*kept, F.explode(F.array_compact(found)).alias("_p"))
    part = {name: F.col("_p")[at] for at, name in enumerate(_PARTS)}
    # a line with a date beyond any calendar is no entry
    dated = [(part[n] == "") | _small(part[n]).isNotNull() for n in ("year", "day", "hour", "minute")]
    matched = matched.filter(dated[0] & dated[1] & dated[2] & dated[3])
    form, mark = part["form"], _unspelt(part["mark"])
    months = F.array(*[F.lit(m) for m in MONTHS])
    hour = F.coalesce(_small(part["hour"]), F.lit(0)).cast("bigint")
    staged = matched.select(
        *kept,
        form.alias("_form"),
        mark.alias("_mark"),
        _unspelt(part["name"]).alias("_name"),
        _number(part["size"]).alias("_size"),
        _year(_small(part["year"]), form == "dos").alias("_year"),
        F.coalesce(
            _small(part["month"]).cast("bigint"), F.array_position(months, F.lower(part["month"]))
        ).alias("_month"),
        F.coalesce(_small(part["day"]), F.lit(0)).alias("_day"),
        (
            F.when(part["half"] == "", hour)
            .when(part["half"] == "P", hour % 12 + 12)
            .otherwise(hour % 12)
            * 3600
            + F.coalesce(_small(part["minute"]), F.lit(0)) * 60
        ).alias("_clock"),
        # only facts closed by a comma count
        F.when(
            form == "facts", F.concat(F.lit(","), F.regexp_extract(mark, r"(?s)\A.*,", 0))
        ).alias("_facts"),
    )
    c = {name: F.col(f"_{name}") for name in ("name", "size", "year", "month", "day", "facts")}
    facts, unix, versioned = (F.col("_form") == f for f in ("facts", "unix", "versioned"))
    kind = F.substring("_mark", 1, 1)
    year = F.coalesce(c["year"], _guessed_year(c["month"], c["day"], as_of))
    folder = c["name"].rlike(r"(?s).\.DIR\z")
    name = F.when(unix & (kind == "l"), F.regexp_replace("_name", r"(?s) -> .*\z", ""))
    name = name.when(versioned & folder, F.regexp_replace("_name", r"\.DIR\z", ""))
    # one server indents names by three blanks
    indented = unix & F.col("_mark").rlike(r"\A.\[?\z")
    name = name.when(indented & c["name"].rlike(r"\A {3}."), F.substr("_name", F.lit(4)))
    is_dir = (
        F.when(facts, c["facts"].contains(",/"))
        .when(unix, kind.isin("d", "l"))
        .when(versioned, folder)
        .otherwise(F.col("_mark") == "<")
    )
    return staged.select(
        *kept,
        name.otherwise(c["name"]).alias("name"),
        F.when(facts, _number(_fact(c["facts"], r"(?s)\A.*,s([0-9]+),")))
        .otherwise(c["size"])
        .alias("size"),
        F.when(facts, _number(_fact(c["facts"], r"(?s)\A.*,m([0-9]+),")))
        .otherwise(_day_seconds(year, c["month"], c["day"]) + F.col("_clock"))
        .alias("mtime"),
        F.when(facts, F.when(c["facts"].rlike(",m[0-9]+,"), "local"))
        .when(unix & c["year"].isNotNull(), "day")
        .otherwise("minute")
        .alias("mtime_kind"),
        is_dir.alias("is_dir"),
        F.when(facts, c["facts"].contains(",r"))
        .when(unix, kind.isin("-", "l"))
        .otherwise(~is_dir)
        .alias("is_file"),
        F.when(facts, _fact(c["facts"], r"(?s)\A.*,i([^,]*),")).alias("id"),
    )
