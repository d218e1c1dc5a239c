import zlib

from framewise.llm import language_id as li
from framewise.llm.common import read_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_answers(spark):
    docs = read_documents(spark, SF)
    out = li.op10_language_id(docs).toPandas().merge(docs.toPandas()[["doc_id", "lang", "text"]], on="doc_id")
    assert len(out) == docs.count()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()
    assert out.lang_rejected.mean() < 0.2


def test_texts_without_letters_are_undetermined():
    model = li.train(["the thing of it", "la chose de la", "das ding der"] * 4, ["en", "fr", "de"] * 4)
    score = model.scorer()
    assert score(None)[0] == score("")[0] == score("12 34 !?")[0] == -1
    assert score("la chose")[0] == model.langs.index("fr")


def test_long_texts_are_read_in_slices(monkeypatch):
    text = "la chose est là " * 400 + "das ding " * 300
    whole = li.bag(text)
    monkeypatch.setattr(li, "SLICE", 1000)
    cut = li.bag(text)
    assert (whole[0] == cut[0]).all() and abs(whole[1] - cut[1]).max() < 1e-7


def test_subwords_stay_inside_letter_runs():
    assert (li.bag("ab cd")[0] == li.bag("AB  cd.")[0]).all()
    a, b = set(li.bag("ab")[0]), set(li.bag("cd")[0])
    assert set(li.bag("ab 12 cd")[0]) == a | b


def test_nothing_to_learn_from():
    assert li.train([], []).langs == []
    assert li.train(["12", "34"], ["en", "fr"]).langs == []


def test_every_language_is_learned_and_copies_count_once(spark, monkeypatch):
    """More languages than any fixed list: all can be predicted, and a repeated row does not fill the sample."""
    seen = []
    monkeypatch.setattr(li, "train", lambda texts, langs: seen.append((texts, langs)))
    rows = [(i * 300 + k, f"text {i} of {k}", f"l{k}") for k in range(300) for i in range(3)] + [(7, "again and again", "l7")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    li.fit_language_model(docs)
    li.fit_language_model(docs, most_rows=300)
    (texts, langs), (_, fewer) = seen
    assert set(langs) == {f"l{k}" for k in range(300)} and texts.count("again and again") == 1
    assert len(fewer) < 600
    li.fit_language_model(docs.filter("false"))
    assert seen[-1] == ([], [])
