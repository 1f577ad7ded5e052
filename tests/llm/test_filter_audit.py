"""The audit against every order walked document by document."""

from collections import Counter, defaultdict
from itertools import permutations

import pytest

from quayflow.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, part string, mask string, good int"
LABELS = "doc_id long, quality int, toxic int, part string"
ORDERS = ["".join(order) for order in permutations("ABCDE")]

LONG = " ".join(f"w{i}" for i in range(210))
ROWS = [
    (1, LONG, "a"),
    (2, LONG, "b"),
    (3, LONG + " #", "a"),
    (3, LONG, "a"),
    (1, LONG, "a"),
    (4, "the " * 300, "a"),
    (5, "THE " * 300, ""),
    (6, None, None),
    (7, "", "c"),
    (8, " \t\x0b", "c"),
    (9, "A" * 3 + "é" * 147, "c"),
    (10, "AAA" + "é" * 146, "c"),
    (11, "a b " * 200 + "|", "c"),
    (None, LONG, "a"),
    (None, "no id", "d"),
    (12, "no id", "d"),
    (13, "word " * 200_000, "d"),
]
LABEL_ROWS = [(1, 1, 0), (1, 0, 1), (2, None, None), (4, 1, 1), (5, 0, 1), (6, 1, 0), (99, 1, 1), (None, 1, 1)]


def failures(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, source in rows:
        text = t or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
        fails += "D" * any(c in text for c in "#$%&*|")
        fails += "E" * (i is not None and i > least[text])
        yield i, source or "", fails


def brute(rows, labels):
    good, toxic = ({i for i, *x, in labels if i is not None and x[k] == 1} for k in (0, 1))
    cells = defaultdict(Counter)
    shapley = Counter()
    marked = list(failures(rows))
    for i, part, fails in marked:
        for order in ORDERS:
            gone = False
            for step, f in enumerate(order, 1):
                cell = cells[part, order, step]
                hit = f in fails
                cell["removed"] += hit and not gone
                cell["redundant"] += hit and gone
                cell["unique_fails"] += fails == f
                cell["good_lost"] += hit and not gone and i in good
                cell["toxic_lost"] += hit and not gone and i in toxic
                shapley[part, f] += hit and not gone
                gone |= hit
                cell["kept"] += not gone
    return {
        (*key, c["kept"], c["removed"], c["redundant"], c["unique_fails"], c["good_lost"], c["toxic_lost"],
         shapley[key[0], key[1][key[2] - 1]])
        for key, c in cells.items()
    }


def frames(spark, rows=ROWS, labels=LABEL_ROWS):
    docs = spark.createDataFrame([(i, t, s, "p", "m", 9) for i, t, s in rows], SCHEMA)
    return docs, spark.createDataFrame([(*r, "x") for r in labels], LABELS)


NAMES = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("labels", [LABEL_ROWS, []])
def test_audit_equals_brute_force(spark, labels):
    docs, marks = frames(spark, labels=labels)
    found = filter_audit.audit(filter_audit.document_masks(docs, marks), "ABCDE")
    rows = found.select(NAMES).collect()
    assert {tuple(r) for r in rows} == brute(ROWS, labels)
    assert len(rows) == 600 * 5
    assert {n: t for n, t in found.dtypes if n in NAMES[3:]} == dict.fromkeys(NAMES[3:], "bigint")


def test_no_documents(spark):
    docs, marks = frames(spark)
    assert filter_audit.audit(filter_audit.document_masks(docs.limit(0), marks), "ABCDE").count() == 0


def test_other_filters(spark):
    """Three filters of any kind, given as masks."""
    masks = spark.createDataFrame([("p", m, m + 1, 0, m) for m in range(8)] * 2, "part string, mask int, rows long, good long, toxic long")
    found = {(r.filter_order, r.step): r for r in filter_audit.audit(masks, "XYZ").collect()}
    assert len(found) == 18
    total = 2 * sum(range(1, 9))
    for order in map("".join, permutations("XYZ")):
        gone = 0
        for step, f in enumerate(order, 1):
            bit, before = 1 << "XYZ".index(f), sum(1 << "XYZ".index(x) for x in order[: step - 1])
            hit = [m for m in range(8) if m & bit and not m & before]
            gone += 2 * sum(m + 1 for m in hit)
            row = found[order, step]
            assert (row.removed, row.kept, row.toxic_lost) == (2 * sum(m + 1 for m in hit), total - gone, 2 * sum(hit))
            assert row.unique_fails == 2 * (bit + 1)


def test_intervals_are_disjoint_and_whole():
    covered = Counter()
    for mask, step, first, after in filter_audit.removal_intervals(5):
        covered.update((mask, rank) for rank in range(first, after))
        for rank in range(first, after):
            hits = ["ABCDE".index(f) for f in ORDERS[rank]]
            assert [bool(mask >> f & 1) for f in hits][:step] == [False] * (step - 1) + [True]
    assert covered == dict.fromkeys(((m, r) for m in range(1, 32) for r in range(120)), 1)
