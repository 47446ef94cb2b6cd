import hashlib

from helpers import CASES, documents

from tidemark.llm import fingerprints


def in_order(rows):
    return sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def compared(spark, rows):
    return fingerprints.compared_with_edit(documents(spark, rows)).collect()


def test_cases_against_plain_python(spark):
    rows = [*CASES, (9, "a\n\nb\nc"), (10, "a\nb\n\nc"), (11, "Same text. Here it is."), (12, "Same text. Here it is.")]
    ordered = in_order(rows)
    want = []
    for at, (key, text) in enumerate(ordered):
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + ordered[(at + 1) % len(ordered)][1][:quarter]
        want.append((key, len(text), edited))
    got = compared(spark, rows)
    assert sorted(((r["id"], r["n_chars"], r["edited"]) for r in got), key=repr) == sorted(want, key=repr)
    roots = {}
    for r in got:
        for text, node in ((r["edited"], r["edited_fingerprint"]),):
            assert roots.setdefault(text, node) == node
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["edited_paragraph"] is None) == (r["fingerprint"] == r["edited_fingerprint"])
    assert len(set(roots.values())) == len(roots)
    by_key = {r["id"]: r for r in got}
    assert by_key[9]["fingerprint"] != by_key[10]["fingerprint"]
    assert by_key[11]["fingerprint"] == by_key[12]["fingerprint"] and by_key[11]["near_next"] == 1.0


def test_ranges_give_the_same_next_documents(spark):
    rows = [(i * i * 10**12, f"text {i} " * (i % 7)) for i in range(200)] + [(10**12, "again")] * 5
    table = fingerprints.with_next(documents(spark, rows), "doc_id", "text", rows_per_range=16)
    ordered = in_order(rows)
    want = sorted((k, t, ordered[(i + 1) % len(ordered)][1]) for i, (k, t) in enumerate(ordered))
    assert sorted((r["id"], r["text"], r["next_text"]) for r in table.where("NOT guest").collect()) == want


def test_only_document_and_empty_table(spark):
    (row,) = compared(spark, [(1, "abcdefgh")])
    assert row["edited"] == "abcdefab" and row["near_next"] == 1.0
    assert compared(spark, []) == []


def test_differing_branch_is_located(spark):
    a, b = "one\ntwo\n\nthree\nfour", "one\ntwo\n\nthree\nFOUR"
    table = spark.createDataFrame([(a, b), (a, a), (a, "one\n\ntwo\nthree\nfour")], "a string, b string")
    tree = fingerprints.tree
    found = table.select(fingerprints.first_difference(tree(table.a), tree(table.b)).alias("at"), fingerprints.root(tree(table.a)).alias("r"))
    assert [r["at"] for r in found.collect()] == [3, None, 1]
    def digest(x):
        return hashlib.md5(x.encode()).hexdigest()

    sections = [digest("".join(digest(p) for p in s.split("\n"))) for s in a.split("\n\n")]
    assert found.first()["r"] == hashlib.sha256("".join(sections).encode()).hexdigest()
