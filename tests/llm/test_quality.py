"""Line-first cleaning against a plain statement of its counts and rules."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


PROSE = " ".join(f"word{k}" for k in range(30)) + "."
CASES = [
    None, "", " \t\n\x0b\r\n ", "a", PROSE, PROSE + "\n" + PROSE, "x y " * 40, " ".join(f"w{k % 9}" for k in range(50)), "a\n a\na\n\n\na\r\na",
    "ein Wort 😀 ü|#*$%&<> ", ("one two three four five six seven eight. " * 2) + PROSE, "\x1f\x00a b" * 9, "same " * 7 + "end", "same " * 9,
]


def table(spark, texts):
    rows = [(k, t, 1.0, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, line double, quality string")


def test_counts_equal_plain_ones(spark, rng=__import__("random").Random(3)):
    texts = CASES + ["".join(rng.choice("ab  \n#|") for _ in range(rng.randint(0, 200))) for _ in range(150)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.clean(table(spark, texts)).select("doc_id", "line", *[f"quality.{c}" for c in [*names, "base_failed", "kept"]]).collect()
    assert len(got) == len(texts)
    for row in got:
        want = by_hand(texts[row.doc_id])
        assert tuple(row[c] for c in names) == want, texts[row.doc_id]
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (row.base_failed and row.kept) and row.line == 1.0


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("A plain sentence with some words.", None), ("Wirklich?", None), ("„Zitat“ und »Schluss.«  ", None), ("他走了。", None), ("She said “no.”\r", None),
        ("Home About Contact", "punctuation"), ("Home | About | Contact | Imprint.", "navigation"), ("Start » Shop » Shoes.", "navigation"),
        ("STOP!! NOW!! READ!! THIS.", "marks"), ("Fine*** print$$$ here.", "marks"), ("All Rights Reserved.", "boilerplate"), ("Please accept all cookies.", "boilerplate"),
        ("word " * 30 + "privacy policy.", None), ("One | two and many more words that make a line of prose out of this.", None),
    ],
)
def test_rules_of_a_line(spark, line, rule):
    row = spark.createDataFrame([(line,)], "line string").select(quality.failed_rule(F.col("line")).alias("rule")).first()
    assert row.rule == rule


def test_failed_lines_go_and_documents_that_lose_too_much(spark):
    little = "Home | About | Us.\n" + PROSE + "\n\n" + PROSE.replace("word", "other") + "\nAll rights reserved."
    much = PROSE + "\n" + PROSE.replace("word", "no").rstrip(".")
    got = {r.doc_id: r.quality for r in quality.clean(table(spark, [little, much, little, None, ""])).collect()}
    assert got[0].kept and got[0].cleaned == PROSE + "\n\n" + PROSE.replace("word", "other")
    assert [(r.line, r.rule) for r in got[0].removed] == [(0, "navigation"), (4, "boilerplate")]
    assert got[0].lost_chars == len("Home|About|Us.") + len("Allrightsreserved.")
    assert not got[1].base_failed and not got[1].kept and [r.rule for r in got[1].removed] == ["punctuation"]
    assert got[2] == got[0]
    for k in (3, 4):
        assert got[k].cleaned == "" and got[k].base_failed and not got[k].kept and got[k].removed == []


def test_an_empty_table_stays_empty_and_no_python_runs(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, _base int, _lines int, _result int")
    found = quality.clean(docs)
    assert found.count() == 0 and found.columns == [*docs.columns, "quality"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_long_text_of_one_repeated_line(spark):
    row = quality.clean(table(spark, ["ab cd ef.\n" * 20000])).select("quality.*").first()
    assert (row.n_words, row.n_dup_lines, row.n_repeat_words, row.base_failed) == (60000, 19999, 60000, True)
