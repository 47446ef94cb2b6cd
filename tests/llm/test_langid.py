import pytest
from helpers import CASES, documents
from pyspark.sql import functions as F

from tidemark.llm import langid

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    return docs, langid.fit(docs.where("NOT held_out"))


def test_held_out_accuracy_and_calibration(trained):
    docs, model = trained
    rows = langid.predict(docs, model).where("held_out").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert sum(right) >= 0.98 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)
    assert abs(sum(r["score"] for r in rows) - sum(right)) <= 0.03 * len(rows)


def test_cases(spark, trained):
    _, model = trained
    table = langid.predict(documents(spark, [*CASES, (60, "123 456 !!")]).withColumn("score", F.lit("given")), model)
    rows = {r["doc_id"]: r for r in table.collect() if r["doc_id"] is not None}
    for key in (2, 3, 4, 8, 60):
        assert (rows[key]["lang_pred"], rows[key]["score"], rows[key]["rejected"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert table.count() == len(CASES) + 1
    assert langid.predict(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    model = langid.fit(documents(spark, [(1, None), (2, "  ")]))
    assert model.predict("text") == ("und", 0.0)
    assert langid.fit(documents(spark, [])).languages == ()


def test_sample_is_bounded_and_independent_of_order(trained):
    docs, _ = trained
    a, b = (langid.fit(docs.orderBy(F.col("doc_id") * s), per_language=20) for s in (1, -1))
    assert (a.weights == b.weights).all() and a.languages == ("de", "en", "es", "fr")


def test_long_texts_are_read_in_pieces(trained, monkeypatch):
    _, model = trained
    text = "Thatornt the onre hesh thti edtionhe anerwhhe " * 200
    whole = model.logits(text)
    monkeypatch.setattr(langid, "PIECE", 500)
    assert abs(model.logits(text) - whole).max() < 0.05


# Languages that the documents are not in, by script.
UNSEEN = {
    "russian": "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему",
    "chinese": "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽",
    "greek": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και τρώω το φαγητό μου κάθε μέρα",
    "arabic": "كان يا ما كان في قديم الزمان ملك عظيم يحكم بلادا واسعة",
    "finnish": "Yhdeksän päivää myöhemmin hän käveli yksin jäätyneen järven yli kohti kylää, jossa hänen äitinsä yhä asui",
    "hungarian": "Egyszer volt, hol nem volt, volt egyszer egy szegény ember, akinek három fia és egy öreg szamara volt",
}


def test_unseen_languages_are_rejected(spark, trained):
    docs, model = trained
    rejected = {name: model.judge(text * 3)[2] for name, text in UNSEEN.items()}
    assert all(rejected[name] for name in ("russian", "chinese", "greek", "arabic")), rejected
    assert sum(rejected.values()) >= 5, rejected
    held = langid.predict(docs, model).where("held_out AND lang_pred != 'und'").collect()
    assert sum(r["rejected"] for r in held) <= 2 * langid.REJECTED * len(held) + 1


def test_new_grams_count_in_long_texts_of_pieces(trained, monkeypatch):
    _, model = trained
    text = (UNSEEN["russian"] + " ") * 30
    monkeypatch.setattr(langid, "PIECE", 200)
    assert model.judge(text)[2] and model._read(text)[1] > 0.9
