"""Text expressions. All of them are built-in JVM expressions; no Python runs per row."""

from __future__ import annotations

import functools
import re
import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space is the Unicode property plus the separators U+001C-U+001F: 29 characters in all.
# One property test is about twice as fast as a class that lists the ranges.
WS = r"(?U:[\s\x1c-\x1f])"
# Runs of white space other than a single space.
WS_RUN = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"
NON_WS = r"(?U:[^\s\x1c-\x1f])"

# Line ends as a universal-newline splitter sees them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# Removed in this order, ignoring case. The order carries meaning: a bare date is
# gone before a phrase ending in a date is looked for.
REMOVAL_PATTERNS = [
    r"Page \d+ / \d+",
    r"Seite \d+ von \d+",
    r"\d{2}\.\d{2}\.\d{4}",
    r"\d{4}\.RRGR\.\d+",
    r"\d{3}-\d{4}",
    r"RRB-Nr\.:?",
    r"Direktion:?",
    r"Klassifizierung:?",
    r"Antrag Regierungsrat:?",
    r"Weitere Unterschriften:?",
    r"Eingereicht am:?",
    r"Geschäftsnummer:?",
    r"Richtlinienmotion:?",
    r"Vorstossart:?",
    r"Vorstoss-Nr\.:?",
    r"https?://\S+",
    r"www\.\S+",
    r"Fraktionsvorstoss:?",
    r"Kommissionsvorstoss:?",
    r"Eingereicht von:?",
    r"Dringlichkeit verlangt:?",
    r"Dringlichkeit gewährt:?",
    r"Nicht klassifiziert",
    r"Auswahl",
    r"Letzte Bearbeitung: \d{2}\.\d{2}\.\d{4}",
    r"Version: \d+",
    r"Dok\.-Nr\.: \d+",
    r"Geschäftsnummer: \d{4}\.RRGR\.\d+",
    r"Parlamentarischer Vorstoss",
    r"Motion",
    r"Nein",
    r"\bEVP\b",
    r"\bSP\b",
    r"\bGLP\b",
    r"\bCVP\b",
    r"\bEDU\b",
    r"\bFDP\b",
    r"\bSVP\b",
    r"Letzte Bearbeitung",
    r"Verteiler",
    r"Grosser Rat",
]

#: Characters that a part of a text has at least when patterns are removed.
PART = 128

SECTION_MARKER = "Antrag Regierungsrat"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: Column | str) -> Column:
    # a single space stays as it is: to replace each of them by itself takes most of the time
    return F.trim(F.regexp_replace(_col(c), WS_RUN, " "))


def strip_whitespace(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"^{WS}+|{WS}++\\z", "")


def clean_simple(c: Column | str) -> Column:
    """One line, single spaces, no outer space; null becomes the empty string."""
    return collapse_whitespace(F.coalesce(_col(c), F.lit("")))


def clean_basic(c: Column | str) -> Column:
    """As :func:`clean_simple`, but null stays null."""
    return collapse_whitespace(c)


def required_literal(pattern: str) -> str:
    """Longest piece of plain ASCII text that every match must contain, in lower case.

    Empty when the pattern has groups, classes or alternatives, or no such piece.
    """
    runs, run, i = [], "", 0
    while i < len(pattern):
        char = pattern[i]
        if char in "|()[]^$":
            return ""
        literal = char if char != "." else None
        i += 1
        if char == "\\":
            literal = pattern[i] if not pattern[i].isalnum() else None
            i += 1
        quantifier = re.match(r"[?*+]|\{\d+(?:,\d*)?\}", pattern[i:])
        if quantifier:
            i += quantifier.end()
        if literal is None or quantifier or not literal.isascii():
            runs.append(run)
            run = ""
        else:
            run += literal
    return max([*runs, run], key=len).lower()


def _atoms(pattern: str) -> list[tuple[str, bool]] | None:
    """The pattern's characters, ``\\d``, ``\\S`` and ``\\b`` in order, and whether a match may lack them; None if it has more."""
    out, i = [], 0
    while i < len(pattern):
        atom = pattern[i]
        if atom in "|()[]{}^$.?*+" or pattern[i : i + 2] in ("\\", "\\\\"):
            return None
        i += 1
        if atom == "\\":
            atom = "\\" + pattern[i] if pattern[i].isalnum() else pattern[i]
            i += 1
        if (len(atom) == 2 and atom not in (r"\d", r"\S", r"\b")) or (atom.isspace() and atom != " "):
            return None
        quantifier = re.match(r"([?*+]|\{\d+(?:,\d*)?\})[?+]?", pattern[i:])
        if quantifier:
            i += quantifier.end()
        out.append((atom, atom == r"\b" or bool(quantifier and quantifier[1].startswith(("?", "*", "{0")))))
    return out


def needs_digit(pattern: str) -> bool:
    """Whether every match must hold a digit."""
    return (r"\d", False) in (_atoms(pattern) or [])


def cut_letters(patterns: Sequence[str]) -> str:
    """Small letters that no match begins with and that no match has behind a space; none if that can't be told.

    A space and such a letter (small or capital) next to it stay as long as both are there: a match would
    have to begin with the letter or to go on from the space to it. So both stay, no match reaches from one
    side of them to the other, and a text may be cut in front of the space: its parts lose what the whole would.
    """
    letters = set(string.ascii_lowercase)
    for pattern in patterns:
        atoms = _atoms(pattern)
        if atoms is None:
            return ""
        for behind in [0, *(n + 1 for n, (atom, _) in enumerate(atoms) if atom == " ")]:
            for atom, optional in atoms[behind:]:
                if atom == r"\S":
                    return ""
                if len(atom) == 1:
                    letters -= set(atom.lower() + atom.upper().lower() + atom.casefold())
                if not optional:
                    break
            else:  # a match may end with the space
                return ""
    return "".join(sorted(letters))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.transform(F.array(value), use)[0]


def _folded(c: Column) -> Column:
    """Lower case, with the three leftovers that case-blind matching equates to s and i mapped."""

    def mapped(low: Column) -> Column:
        odd = F.contains(low, F.lit("\u017f")) | F.contains(low, F.lit("\u0131")) | F.contains(low, F.lit("\u0307"))
        return F.when(odd, F.translate(low, "\u017f\u0131\u0307", "si")).otherwise(low)

    return _once(F.lower(c), mapped)


def remove_patterns(c: Column | str, patterns: Sequence[str] = REMOVAL_PATTERNS, part: int = PART) -> Column:
    """Remove each pattern in turn, ignoring case over all of Unicode.

    A text is cut into parts of ``part`` characters and more where no match can reach across (see
    :func:`cut_letters`; a line end does as well), and each part goes through all patterns in turn. There, a
    pattern runs only if the part, as it is by then, holds the plain text that it needs: a substring search costs
    a small part of a case-blind scan, and most patterns are absent from most parts.
    """
    steps = F.array(
        *[
            F.struct(
                F.lit(required_literal(p)).alias("need"),
                F.lit(needs_digit(p)).alias("digit"),
                F.lit(n).alias("number"),
            )
            for n, p in enumerate(patterns)
        ]
    )

    def removed(text: Column, number: Column) -> Column:
        # each pattern is a literal in a branch of its own, which Spark compiles once for a task
        out = text
        for n, p in enumerate(patterns):
            regex = F.lit("(?iU)" + p.replace(r"\S", NON_WS))
            replaced = F.regexp_replace(text, regex, F.lit(""))
            out = F.when(number == n, replaced) if n == 0 else out.when(number == n, replaced)
        return out

    def state(text: Column) -> Column:
        return F.struct(text.alias("text"), _folded(text).alias("low"), text.rlike(r"(?U)\d").alias("digits"))

    def apply(acc: Column, step: Column) -> Column:
        ran = _once(
            removed(acc["text"], step["number"]),
            lambda new: F.when(new != acc["text"], state(new)).otherwise(acc),
        )
        may = F.contains(acc["low"], step["need"]) & (acc["digits"] | ~step["digit"])
        return F.when(may, ran).otherwise(acc)

    def chain(text: Column) -> Column:
        def unless_plain(start: Column) -> Column:
            # spelled out, as a loop over the steps takes longer than the searches
            may = [F.contains(start["low"], F.lit(required_literal(p))) & (start["digits"] if needs_digit(p) else F.lit(True)) for p in patterns]
            return F.when(functools.reduce(Column.__or__, may), F.aggregate(steps, start, apply, lambda acc: acc["text"])).otherwise(start["text"])

        return _once(state(text), unless_plain)

    if not patterns:
        return _col(c)
    letters = cut_letters(patterns)
    if not letters:
        return chain(_col(c))
    cut = rf"(?s).{{{part}}}.*?(?=\n| [{letters}{letters.upper()}])|.+"
    return F.array_join(F.transform(F.regexp_extract_all(_col(c), F.lit(cut), F.lit(0)), chain), "")


def strip_special_chars(c: Column | str) -> Column:
    """Keep ASCII letters, digits, white space and ``.,!?-``."""
    return F.regexp_replace(_col(c), r"(?U)[^a-zA-Z0-9\s\x1c-\x1f.,!?-]", "")


def punctuation_spacing(c: Column | str) -> Column:
    """Drop white space in front of ``.,!?``."""
    return F.regexp_replace(_col(c), f"{WS}+([.,!?])", "$1")


def clean_advanced(c: Column | str, patterns: Sequence[str] = REMOVAL_PATTERNS) -> Column:
    """Collapse white space, remove the patterns, keep basic characters, fix punctuation."""
    return punctuation_spacing(strip_special_chars(remove_patterns(clean_basic(c), patterns)))


CLEANERS: dict[str, Callable[[Column], Column]] = {
    "simple": clean_simple,
    "basic": clean_basic,
    "advanced": clean_advanced,
}


def get_cleaner(cleaner: str | Callable[[Column], Column] = "basic") -> Callable[[Column], Column]:
    """Cleaner by name; a function from Column to Column is taken as it is."""
    if callable(cleaner):
        return cleaner
    if cleaner not in CLEANERS:
        raise ValueError(f"unknown cleaner {cleaner!r}; choose from {sorted(CLEANERS)}")
    return CLEANERS[cleaner]


def is_nonblank(c: Column | str) -> Column:
    """True where some character is not white space; null counts as blank."""
    return F.coalesce(_col(c).rlike(NON_WS), F.lit(False))


def tokenize(c: Column | str) -> Column:
    """Lower-case words between runs of white space."""
    words = F.split(F.lower(_col(c)), f"{WS}+")
    return F.array_remove(words, "")


def keyword_lower(c: Column | str) -> Column:
    return F.transform(_col(c), F.lower)


def contains_marker(c: Column | str, marker: str = SECTION_MARKER) -> Column:
    return F.contains(_col(c), F.lit(marker))


def section_after_marker(c: Column | str, marker: str = SECTION_MARKER) -> Column:
    """Text behind the first marker without its first line, cleaned line by line.

    Null where the marker is missing, so that such rows can be counted or dropped.
    """
    text = _col(c)
    start = F.locate(marker, text)
    rest = strip_whitespace(F.substr(text, start + F.lit(len(marker))))
    lines = F.split(rest, LINE_END, -1)
    body = F.filter(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), is_nonblank)
    return F.when(start > 0, F.array_join(F.transform(body, clean_basic), " "))


def text_preview(c: Column | str, n: int = 100) -> Column:
    return F.substring(_col(c), 1, n)


def format_label(kind: Column | str, confidence: Column | str) -> Column:
    return F.format_string("Type: %s, Conf: %.2f", _col(kind), _col(confidence))


# Name parts of a path ---------------------------------------------------------------------

def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def file_stem(path: Column | str) -> Column:
    """Name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(file_name(path), r"(?s)(?<=.)\.[^.]*\z", "")


def page_image_name(path: Column | str, page: Column | str) -> Column:
    return F.format_string("%s_page_%d.png", file_stem(path), _col(page))


# Markup to text ---------------------------------------------------------------------------

# Applied in this order to turn an HTML page into text.
HTML_STEPS = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?i)<(?:/?(?:p|div|li|ul|ol|tr|table|article|section|nav|header|footer|title|h[1-6])|br)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
    (r"&nbsp;|&#160;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;|&apos;", "'"),
    (r"&amp;", "&"),
]


def html_to_text(c: Column | str) -> Column:
    out = _col(c)
    for pattern, replacement in HTML_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return out
