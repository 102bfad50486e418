from normwerk.llm import characters as ch
from normwerk.llm import repair as R

TEXTS = [
    ("Gesetz über die Prüfung", "Gesetz über die Prüfung", False, 0),
    ("Gesеtz", "Gesetz", False, 1),  # Cyrillic е
    ("Gеsеtz übеr", "Gesetz über", False, 2),
    ("Ges­etz​", "Gesetz", True, 0),
    ("Ｇｅｓｅｔｚ　die", "Gesetz die", True, 0),
    ("Prüfung", "Prüfung", True, 0),
    ("Stoﬀ Teil Ⅳ", "Stoff Teil IV", True, 0),
    ("EU‑weit", "EU-weit", True, 0),
    ("Teil ΙΙΙ", "Teil ΙΙΙ", False, 1),  # wholly Greek capitals, not in the vocabulary
    ("α-Zerfall – „m²“ CO₂ §", "α-Zerfall – „m²“ CO₂ §", False, 0),
    ("Наредба за храните", "Наредба за храните", False, 0),
    ("Наpeдба", "Наредба", False, 1),  # Latin p and e in Cyrillic
    ("Μεταφορών", "Μεταφορών", False, 0),
    ("Ххzyх", "Ххzyх", False, 1),  # no such word
    ("", "", False, 0),
    (None, None, False, 0),
]


def test_repair(spark):
    rows = [("t", str(i), x[0]) for i, x in enumerate(TEXTS)] + [("t", "1", TEXTS[1][0]), ("t", None, "Gesеtz"), (None, "9", "x" * 200_000)]
    df = spark.createDataFrame(rows, "record_table string, record_key string, text string").selectExpr("*", "1 as plain", "2 as mixed")
    got = R.repair(df).collect()
    assert len(got) == len(rows)
    by_key = {r.record_key: r for r in got if r.record_table and r.record_key}
    for i, (_, repaired, odd, alike) in enumerate(TEXTS):
        r = by_key[str(i)]
        assert (r.repaired, r.odd_characters, r.look_alikes) == (repaired, odd, alike), r
    assert by_key["13"].unrepaired == 1 and by_key["1"].unrepaired == 0
    assert [r.repaired for r in got if r.record_key is None] == ["Gesetz"]
    again = R.repair(spark.createDataFrame([(r.record_table, r.record_key, r.repaired) for r in got], "record_table string, record_key string, text string"))
    assert {(r.record_key, r.repaired) for r in again.collect()} == {(r.record_key, r.repaired) for r in got}


def test_shuffled_vocabulary_is_the_same(spark, monkeypatch):
    df = spark.createDataFrame([("t", "1", "Gesеtz"), ("t", "2", "das Gesetz")], "record_table string, record_key string, text string")
    monkeypatch.setattr(R, "MOST_BROADCAST", 0)
    assert sorted(r.repaired for r in R.repair(df).collect()) == ["Gesetz", "das Gesetz"]
    assert R.repair(df.limit(0)).count() == 0


def test_scripts():
    assert ch.dominant_script("Gesеtz") == "Latin" and ch.scripts("Gesеtz") == {"Latin", "Cyrillic"}
    assert ch.fold_look_alikes("Gesеtz ΙΙΙ Ｘ") == "Gesetz III X"
    assert ch.to_script("Наpeдба", "Cyrillic") == "Наредба"
    assert ch.recompose("a\x07b\tc") == "ab\tc" and ch.recompose("\u0133") == "ij" and ch.recompose("\u0080x") == "x"
    assert ch.plain_form("\u212a") == "K" and ch.plain_form("²") == "²" and ch.plain_form("…") == "…"


def test_confusable_list(spark):
    table = R.confusables(spark)
    assert table["Ꮪ"] == "S" and table["ı"] == "i" and table["−"] == "-" and "§" not in table
    texts = ["EU−weit", "Werte von 3−5", "Ꮪatzung", "Satzung", "Fıscher", "Fischer", "kapalı", "Wаld–Satz"]
    df = spark.createDataFrame([("t", str(i), t) for i, t in enumerate(texts)], "record_table string, record_key string, text string")
    got = {int(r.record_key): (r.repaired, r.odd_characters or r.look_alikes > 0) for r in R.repair(df).collect()}
    assert [got[i] for i in range(8)] == [("EU-weit", True), ("Werte von 3−5", False), ("Satzung", True), ("Satzung", False), ("Fischer", True), ("Fischer", False), ("kapalı", False), ("Wаld–Satz", True)]


def test_third_form_is_tried(spark):
    # dominant Greek, text in Cyrillic, the known word Latin
    texts = ["ΟΡΤ", "OPT", "Наредба за храните и водите ΟΡT"]
    df = spark.createDataFrame([("t", str(i), t) for i, t in enumerate(texts)], "record_table string, record_key string, text string")
    got = {r.record_key: r.repaired for r in R.repair(df).collect()}
    assert got["2"].split()[-1] in ("ΟΡΤ", "OPT")
