from __future__ import annotations

from collections import Counter

import brute
import oracle

from saleslake.llm import lines
from saleslake.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id long, text string, n_chars int, lines string, at int"
SPACES = " \t\x0b\x0c\r"


def plain(docs):
    """{(id, text): (text left, lines, removed)} by walking the documents in order."""
    seen, out = set(), {}
    for ident, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        every = (text or "").split("\n")
        full = [(i, x.strip(SPACES)) for i, x in enumerate(every) if x.strip(SPACES)]
        gone = set()
        for k in range(len(full) - 2):
            key = tuple(s for _, s in full[k : k + 3])
            if key in seen:
                gone |= {i for i, _ in full[k : k + 3]}
            seen.add(key)
        left = "\n".join(x for i, x in enumerate(every) if i not in gone) if gone else text
        out[ident, text] = (left, len(full), len(gone))
    return out


def test_query_equals_sql(spark):
    frame = QUERIES["op7_line_dedup"](spark, brute.SF)
    oracle.assert_same(frame, oracle.connect(brute.SF), ORACLE_SQL["op7_line_dedup"])
    assert frame.where("n_removed > 0").count() > 10


def test_odd_rows(spark):
    block = "one line\n two lines \n\n\tthree\nfour"
    docs = [
        (1, None), (2, ""), (3, "a\nb"), (4, block), (5, "new\n" + block + "\nend"), (5, "new\n" + block + "\nend"),
        (6, "\n".join(["same"] * 7)), (7, "x\nx\nx"), (8, "\n \n"), (9, block + "\nfive\nsix"), (None, block + "\nnull id"),
        (None, "a\nb\nc"), (10, "a\nb\nc"), (11, "\n".join(str(n) for n in range(20_000)) + "\n1\n2\n3\n4"), (12, "x\n x\n x \n" * 40),
        (12, "q\nr\ns"), (13, "q\r\nr\r\ns\r\nt"),
    ]
    frame = spark.createDataFrame([(i, t, -1, "clash", 7) for i, t in docs], SCHEMA).repartition(3)
    got = lines.deduplicated(frame)
    assert got.columns == [*frame.columns, "lines_"]
    want = plain(docs)
    rows = got.collect()
    expected = Counter()
    for i, t in docs:
        left, n, removed = want[i, t]
        expected[i, left, n, removed, -1 if not removed else len(left)] += 1
    assert Counter((r.doc_id, r.text, r.lines_.n_lines, r.lines_.n_removed, r.n_chars) for r in rows) == expected
    assert all(r.lines == "clash" and r.at == 7 for r in rows)


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lines.deduplicated(none).count() == 0


def test_a_passage_that_most_documents_share(spark):
    passage = "first shared line\nsecond shared line\nthird shared line"
    docs = [(n, f"own {n}\n{passage}\nlast {n}" if n % 3 else f"alone {n}\nb{n}\nc{n}") for n in range(300)]
    got = lines.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = plain(docs)
    assert {r.doc_id: r.text for r in got} == {i: left for (i, _), (left, _, _) in want.items()}
    assert sum(passage in r.text for r in got) == 1
