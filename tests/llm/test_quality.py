import re
from collections import Counter

from pagegraph.llm import quality
from tests.llm.conftest import values

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


CASES = [
    "a b c d e f g h " * 2 + "z " + "a b c d e f g h i",
    "one two three four five six seven eight nine " * 5,
    "same line here\nsame line here\n\n \nsame line here\nother",
    "### *** $$ <x> | & % " * 4,
    "ünï cödé \U0001f600 " * 9,
]


def test_measures_against_brute_force(spark, odd, odd_rows):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((r[0], *by_hand(r[1])) for r in odd_rows), key=repr)
    assert values(quality.ledger(odd), *columns) == want
    cases = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    assert values(quality.ledger(cases), *columns) == [(i, *by_hand(t)) for i, t in enumerate(CASES)]


def test_policies_and_ablations_come_from_the_bits(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good), (2, "few words"), (3, "a b c d e f g h i j " * 10), (4, " ".join(f"w{i} ###" for i in range(30)))]
    book = quality.ledger(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.doc_id for r in book.filter(~quality.fails("v2")).collect()] == [1]
    assert sorted(r.doc_id for r in book.filter(quality.fails("v1")).collect()) == [2, 3]
    told = {r.rule: r for r in quality.ablations(book, "v2").collect()}
    rejected = book.filter(quality.fails("v2")).collect()
    for i, rule in enumerate(quality.RULES):
        if rule.name in quality.POLICIES["v2"]:
            mask = quality.mask("v2")
            assert told[rule.name].failed == sum(bool(r.failed_bits >> i & 1) for r in rejected)
            assert told[rule.name].alone == sum(r.failed_bits & mask == 1 << i for r in rejected)


def test_empty_and_clashing(none, clashing, odd):
    assert quality.ledger(none).count() == 0
    assert quality.ablations(quality.ledger(none)).count() == len(quality.POLICIES["v2"])
    assert values(quality.ledger(clashing), "doc_id", "failed_bits") == values(quality.ledger(odd), "doc_id", "failed_bits")
