import random
import re
import sys
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomdex.functions import text as t
from loomdex.operators.extract import clean_texts_job, section_counters, section_job

SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def apply(spark, fn, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["v"] for r in rows.select("i", fn(F.col("text")).alias("v")).orderBy("i").collect()]


def plain_removal(text):
    for pattern in t.REMOVAL_PATTERNS:
        text = re.sub(pattern, "", text, flags=re.IGNORECASE)
    return text


def test_multiline_text_ends_up_on_one_line(spark):
    text = "A first line\n    with more\n\n  lines and     wide    gaps.\n\n  The end."
    (clean,) = apply(spark, t.clean_simple, [text])
    assert clean == "A first line with more lines and wide gaps. The end."


def test_every_space_character_counts(spark):
    text = SPACES + "a" + "b".join(SPACES) + "c" + SPACES
    assert apply(spark, t.clean_simple, [text]) == [re.sub(r"\s+", " ", text).strip()]
    assert apply(spark, t.tokenize, [text]) == [text.lower().split()]
    assert apply(spark, t.strip_whitespace, [text]) == [text.strip()]
    assert apply(spark, t.is_nonblank, [SPACES, "", "x"]) == [False, False, True]


def test_null_is_empty_for_simple_and_null_for_basic(spark):
    assert apply(spark, t.clean_simple, [None, ""]) == ["", ""]
    assert apply(spark, t.clean_basic, [None, ""]) == [None, ""]


def test_pattern_order_decides(spark):
    # the date is gone before the phrase with a date is looked for, so only its words go later
    got = apply(spark, t.remove_patterns, ["Letzte Bearbeitung: 01.02.2020 x", "Emotionen", "VertNeineiler"])
    assert got == [":  x", "Een", ""]


def test_removal_ignores_case_over_unicode(spark):
    texts = [
        "GESCHÄFTSNUMMER: 5", "äSP SP spé", "MOTİON moTıon", "vorſtoßart vorſtossart", "KlassiKra",
        "https://a.b/c d www.x.y z", "2021.RRGR.77 049-2022 Page 1 / 2",
    ]
    assert apply(spark, t.remove_patterns, texts) == [plain_removal(x) for x in texts]


def test_required_literal():
    assert t.required_literal(r"\bSP\b") == "sp"
    assert t.required_literal(r"https?://\S+") == "http"
    assert t.required_literal(r"RRB-Nr\.:?") == "rrb-nr."
    assert t.required_literal(r"Geschäftsnummer:?") == "ftsnummer"
    assert t.required_literal("a|b") == "" and t.required_literal("(ab)+c") == ""
    assert t.required_literal("abc{0,2}d") == "ab"


def test_where_texts_may_be_cut():
    assert t.cut_letters(t.REMOVAL_PATTERNS) == "ijoqtxyz"
    assert set("abcdefghijklmnopqrstuvwxyz") - set(t.cut_letters([r"\bab? c? d+", "Q{0,2}ſ"])) == set("acdqsi") - set("i")
    for unclear in ("a|b", "(a)b", "a.b", r"\S+", r"a\s", r"x \w", "a ", "a b?", "a\n", "b*", r"a\\Sb"):
        assert t.cut_letters(["Motion", unclear]) == "", unclear
    assert t.needs_digit(r"Page \d+") and not t.needs_digit(r"a\d*") and not t.needs_digit(r"\d|a")


def test_parts_of_a_text_lose_what_the_whole_loses(spark):
    rng = random.Random(5)
    words = ["Motion", "NEIN", "SP", "Seite", "2", "von", "9", "01.02.2020", "to", "is", "x", "Ital", "Ver", "teiler", "/", "Page",
             "Antrag", "Regierungsrat:", "www.a", "Letzte", "Bearbeitung:", "zu", "İ", "\u0131t", "ſ", "Grosser", "Rat", "Version:"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "", "\n", "  "]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    whole = [plain_removal(x) for x in texts]
    for part in (1, 20, 128):
        assert apply(spark, lambda c, part=part: t.remove_patterns(c, part=part), texts) == whole
    patterns = [r"to (is)?", r"\bzu\b", "ver"]  # not to be cut
    assert apply(spark, lambda c: t.remove_patterns(c, patterns), texts) == [
        re.sub("(?i)ver", "", re.sub(r"(?i)\bzu\b", "", re.sub(r"(?i)to (is)?", "", x))) for x in texts
    ]


def test_a_match_in_one_place_starts_no_scans_elsewhere(spark):
    """Time by the place of the only match: the rest of a long text isn't scanned for all patterns."""
    rest = "over all of it there is one thing to tell of that other town " * 40_000
    df = spark.createDataFrame([("Auswahl, " + rest,)], "text string").cache()
    df.count()

    def seconds(c):
        best = []
        for _ in range(3):
            start = time.perf_counter()
            df.select(F.length(c)).collect()
            best.append(time.perf_counter() - start)
        return min(best)

    one_by_one = F.col("text")
    for p in t.REMOVAL_PATTERNS:
        one_by_one = F.regexp_replace(one_by_one, "(?iU)" + p, "")
    assert seconds(t.remove_patterns("text")) < 0.5 * seconds(one_by_one)


word = st.sampled_from(
    ["Motion", "NEIN", "SP", "svp", "Seite 2 von 3", "01.02.2020", "x", "é", "Ä", "-", ".", " ", "\n", " ",
     "\x1d", "www.a", "Dringlichkeit GEWÄHRT:", "ſ", "İ", "Auswahl", "Antrag Regierungsrat"]
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(word, max_size=12).map("".join), min_size=40, max_size=60))
def test_cleaners_agree_with_plain_python(spark, texts):
    def advanced(x):
        x = plain_removal(re.sub(r"\s+", " ", x).strip())
        x = re.sub(r"[^a-zA-Z0-9\s.,!?-]", "", x)
        return re.sub(r"\s+([.,!?])", r"\1", x)

    simple = apply(spark, t.clean_simple, texts)
    assert simple == [re.sub(r"\s+", " ", x).strip() for x in texts]
    assert apply(spark, t.clean_simple, simple) == simple
    assert apply(spark, t.clean_advanced, texts) == [advanced(x) for x in texts]


def test_section_behind_marker(spark):
    marker = t.SECTION_MARKER
    rows = [
        (1, f"head {marker}: first\r\nsecond   line\x0b\n  \nthird last {marker} x"),
        (2, "no marker"),
        (3, f"only {marker}"),
    ]
    df = spark.createDataFrame(rows, "k int, text string")
    got = {r["k"]: r["text"] for r in section_job(df, "k").collect()}
    assert got == {1: f"second line third last {marker} x", 3: ""}
    assert section_counters(df).first().asDict() == {"processed": 3, "cleaned": 2}


def test_cleaning_job_and_unknown_cleaner(spark):
    df = spark.createDataFrame([("a", " x "), ("b", " "), ("c", None)], "filename string, text string")
    got = {r["filename"]: (r["status"], r["text"]) for r in clean_texts_job(df).collect()}
    assert got == {"a": ("success", "x"), "b": ("failed", None), "c": ("failed", None)}
    upper = clean_texts_job(df, cleaner=F.upper).where("filename = 'a'").first()
    assert upper["text"] == " X "
    with pytest.raises(ValueError):
        t.get_cleaner("thorough")


def test_path_parts(spark):
    paths = ["/d/a.b.pdf", "x.txt", "/d/.hidden", "/d/none"]
    assert apply(spark, t.file_stem, paths) == ["a.b", "x", ".hidden", "none"]
    assert apply(spark, lambda c: t.page_image_name(c, F.lit(2)), ["/d/a.pdf"]) == ["a_page_2.png"]
