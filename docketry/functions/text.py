"""Column functions on text: all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V

_BREAKS = "\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
_BREAK = "\r\n|[" + _BREAKS + "]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, also where use needs it inside a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def squash(c) -> Column:
    """Lower case, letters and digits only; blanks go first, as they are most of what goes and need no pattern."""
    return F.regexp_replace(F.replace(F.lower(col(c)), F.lit(" "), F.lit("")), "[^a-z0-9]+", "")


def squash_space(c) -> Column:
    return F.regexp_replace(col(c), r"(?U)\s+", "")


def strip(c) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def strip_prefix(c) -> Column:
    """Without the ordinal, bullet or 'Defect No' at the start."""
    return F.regexp_replace(col(c), "(?iU)" + V.PREFIX, "")


def lines(c) -> Column:
    """The lines of a text; a last empty piece does not count."""
    parts = F.split(col(c), _BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def squashed_lines(c) -> Column:
    """squash of each line of a text, in one pass over the whole; a last line without letters and digits may be left out."""
    text = F.replace(F.replace(F.lower(col(c)), F.lit("\r\n"), F.lit("\n")), F.lit(" "), F.lit(""))
    return F.split(F.regexp_replace(text, f"[^a-z0-9{_BREAKS}]+", ""), f"[{_BREAKS}]", -1)


def count_class(c, klass: str) -> Column:
    """Characters of a class such as \\p{L}."""
    return F.length(col(c)) - F.length(F.regexp_replace(col(c), klass, ""))


def garbled(c) -> Column:
    """More than 2 % control characters: a text layer that decodes to glyph codes."""
    return count_class(c, V.CONTROL) > V.MAX_CONTROL * F.greatest(F.lit(1), F.length(col(c)))


#: The letters outside ASCII that have an ASCII letter as their other case.
_OTHER_CASE = {"s": "\u017f", "k": "\u212a"}


def re2(pattern: str) -> str:
    """A pattern without regard to case, as Java has to be told it for the matches that RE2 (the SQL twins) finds.

    There a word bound is one of ASCII, so that an accented letter ends a word, and a long s and
    the Kelvin sign are an s and a k. Takes letters, classes of ranges a-z, groups, counts and \\b only.
    """
    bound = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"
    out = "".join(f"[{c}{_OTHER_CASE[c]}]" if c in _OTHER_CASE else c for c in pattern)
    return "(?i)" + out.replace("a-z", "a-z" + "".join(_OTHER_CASE.values())).replace(r"\b", bound)


def letters(c) -> Column:
    return count_class(c, r"\p{L}")


def digit_ratio(c) -> Column:
    return count_class(c, r"\p{Nd}") / F.greatest(F.lit(1), count_class(c, r"[\p{L}\p{N}]"))


def needs_reread(c, pages) -> Column:
    return (F.length(col(c)) < V.MIN_CHARS_PAGE * F.greatest(F.lit(1), col(pages))) | garbled(c)


def argue_score(c, pattern: str = V.ARGUES) -> Column:
    """Reply phrases per thousand characters at the start of a text, to two places."""
    head = F.substring(col(c), 1, V.ARGUE_CHARS)
    score = F.lit(1000.0) * F.regexp_count(head, F.lit(pattern)) / F.greatest(F.lit(1), F.length(head))
    return F.floor(score * 100 + 0.5) / 100


def digits(c) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def figures(c, pattern: str = V.FIGURE) -> Column:
    """Distinct figures, thousands marks removed, as strings."""
    return F.array_distinct(F.transform(F.regexp_extract_all(col(c), F.lit(pattern), F.lit(0)), lambda f: F.replace(f, F.lit(","), F.lit(""))))


def unseen_figures(claimed, source, least: int = 4, most: int = 12, strict: bool = False) -> Column:
    """Claimed figures whose digits do not occur in the source, at most six.

    strict compares with whole figures of the source instead of its joined digits.
    """
    seen = transform_digits(figures(source)) if strict else digits(source)

    def unseen(seen):
        def bad(f):
            d = digits(f)
            return F.length(d).between(least, most) & ~(F.array_contains(seen, d) if strict else F.contains(seen, d))

        return F.slice(F.filter(figures(claimed), bad), 1, 6)

    return let(seen, unseen)


def transform_digits(c) -> Column:
    return F.transform(c, lambda f: digits(f))


def words(c) -> Column:
    """Runs of a-z and 0-9 in lower case: what stands between the other characters."""
    return F.array_remove(F.split(F.lower(col(c)), "[^a-z0-9]+", -1), "")


def shingles(c, n: int = V.GROUND_WORDS) -> Column:
    """Distinct runs of n words, each by its 64-bit hash; none below n words."""

    def runs(w):
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)])))

    return let(words(c), runs)


def overlap(a, b, n: int = V.GROUND_WORDS) -> Column:
    """Share of a's word runs that b has; 1 if a has none."""
    return let(shingles(a, n), lambda sa: F.when(F.size(sa) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(sa, shingles(b, n))) / F.size(sa)))


def safe(c) -> Column:
    """Fit for a sheet cell: no control characters, at most 30,000 characters."""
    return F.substring(F.regexp_replace(F.coalesce(col(c), F.lit("")), V.ILLEGAL, ""), 1, V.MAX_CELL)


def row_height(cells, widths=(95, 85, 80)) -> Column:
    """Estimated height of a sheet row: 11.5 for each wrapped line, from 30 to 409."""
    def wrapped(c, width):
        per_line = F.transform(lines(c), lambda x: F.greatest(F.lit(1), F.ceil(F.length(x) / F.lit(width)).cast("int")))
        return F.greatest(F.lit(1), F.aggregate(per_line, F.lit(0), lambda a, b: a + b))

    total = sum((wrapped(c, w) for c, w in zip(cells, widths, strict=False)), F.lit(0))
    return F.least(F.lit(409.0), F.greatest(F.lit(30.0), total * F.lit(11.5)))


def render_table(t) -> Column:
    """A struct (title, headers, rows) as padded text with a rule under the headers."""
    t = col(t)

    def lay(rows):
        def widths(width):
            text = F.transform(rows, lambda r: F.regexp_replace(F.array_join(F.transform(r, lambda c, i: F.rpad(c, F.get(width, i), " ")), "  "), r"(?U)\s+$", ""))
            rule = F.array_join(F.transform(width, lambda w: F.repeat(F.lit("-"), w)), "  ")
            head = F.when(F.coalesce(t["title"], F.lit("")) != "", F.array(t["title"])).otherwise(F.array().cast("array<string>"))
            return let(text, lambda x: F.array_join(F.concat(head, F.slice(x, 1, 1), F.array(rule), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(1)))), "\n"))

        return let(F.transform(t["headers"], lambda h, i: F.array_max(F.transform(rows, lambda r: F.length(F.coalesce(F.get(r, i), F.lit("")))))), widths)

    return let(F.concat(F.array(t["headers"]), t["rows"]), lay)


def numbered(c, start=1) -> Column:
    """Lines with their number before a bar, counted from start."""
    return F.array_join(F.transform(col(c), lambda x, i: F.concat((i + start).cast("string"), F.lit("| "), x)), "\n")


def strip_think(c) -> Column:
    """Without inline reasoning, closed or cut off."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), r"(?s)<think>.*?</think>\s*", ""), r"(?s)<think>.*\z", ""))


def strip_fence(c) -> Column:
    return F.regexp_replace(strip(c), r"^```[a-z]*\n|\n```\z", "")
