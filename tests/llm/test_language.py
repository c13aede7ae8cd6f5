from pyspark.sql import functions as F

from letbook.llm import language
from letbook.llm.queries import op1_language


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = op1_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    right, n = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right >= 0.95
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_backoff(spark, odd):
    train = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "nothing", None)]
    model = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    rows = language._Rows(model)
    en, de = model.langs.index("en"), model.langs.index("de")
    known, unseen = rows.table[rows["katze"]].copy(), rows.table[rows["katzen"]].copy()
    assert known[de] > known[en] and unseen[de] > unseen[en]  # "katzen" goes by its n-grams
    assert rows.unseen("###") == 0.0
    langs, scores, _ = language.score_texts(model, ["THE cats", "die hunde", None, "", "123 !", "水"])
    assert langs[:2] == ["en", "de"] and langs[2:5] == ["und"] * 3 and scores[2:5] == [0.0] * 3
    assert language.predict(odd, model).count() == odd.count()
    empty = odd.limit(0)
    assert language.predict(empty, model).count() == 0
    none = language.fit(empty.select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language.predict(odd, none).collect()} == {"und"}


def test_only_letters_make_words(spark):
    """Fractions, raised figures and numbers in circles are no letters; marks do not cut words; ids may be texts."""
    rows = [("a", "the cat and the dog", "en"), ("b", "der hund und die katze", "de"), (None, "der die das", "de")]
    model = language.fit(spark.createDataFrame(rows, "doc_id string, text string, lang string"))
    langs, scores, _ = language.score_texts(model, ["½", "²³ ① Ⅻ", "1/2 _ -"])
    assert langs == ["und"] * 3 and scores == [0.0] * 3
    assert language.WORD.findall("हिन्दी भाषा x½y") == ["हिन्दी", "भाषा", "x", "y"]
    assert language.predict(spark.createDataFrame(rows, "doc_id string, text string, lang string"), model).count() == 3
