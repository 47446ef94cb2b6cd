from helpers import CASES, documents

from tidemark.llm import line_templates


def dropped(spark, rows, **options):
    table = line_templates.drop_recurring(documents(spark, rows), **options)
    assert table.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"], r["left_whole"]) for r in table.collect()), key=repr)


def test_variable_fields_are_generalised(spark):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [(i, "\n".join([" ".join(f"own{i}x{j}" if j % 2 else words[i] * (j + 1) for j in range(15 + i)),
                           f"Posted on the site by {words[i]} at {i}:30 today", f"Copyright 20{i}0 by us", ""])) for i in range(6)]
    got = dropped(spark, rows, min_docs=5)
    assert got == [(i, rows[i][1].split("\n")[0] + "\n", 3, 2, False) for i in range(6)]


def test_rare_lines_and_copies_stay(spark):
    page = "\n".join(f"A copied page has line number {w} and more" for w in ("one", "two", "three"))
    rows = [(i, page) for i in range(10)] + [(20 + i, f"Own words of page {chr(97 + i) * 9} go on and on\nseen in four only") for i in range(4)]
    got = dropped(spark, rows, min_docs=5)
    assert [(k, t) for k, t, *_ in got] == sorted(rows, key=repr)
    assert {k: whole for k, *_, whole in got} == {k: k < 10 for k, _ in rows}


def test_cases(spark):
    got = dropped(spark, CASES)
    assert [(k, t) for k, t, *_ in got] == sorted(CASES, key=repr)
    assert not any(n for *_, n, _ in got)
    counts = {k: n for k, _, n, _, _ in got}
    assert (counts[1], counts[2], counts[3], counts[4]) == (1, 0, 0, 0)
    assert dropped(spark, []) == []


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "the same row many times\nand its second line here")] * 9
    assert dropped(spark, rows) == [(*rows[0], 2, 0, False)] * 9
