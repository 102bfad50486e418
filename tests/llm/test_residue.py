import re

import pytest

from normwerk.llm import residue as R

LAW = "Die Behörde erteilt die Erlaubnis, wenn die Anforderungen erfüllt sind. Der Antrag ist schriftlich zu stellen und zu begründen. "
CASES = [
    (LAW + "Gebühr: {{ betrag }}.", "placeholder"), (LAW + "am ${datum}", "placeholder"), (LAW + "[HIER ORT EINFÜGEN]", "placeholder"), (LAW + "Nr. XXX", "placeholder"), (LAW + "<%= Frist %>", "placeholder"),
    (LAW + "TT.MM.JJJJ", "placeholder"), (LAW + "die #AZ_NR# Stelle", "placeholder"), (LAW + "nach %s von %d", "placeholder"), (LAW + "__Frist__", "placeholder"), (LAW + "<Name der Stelle>", "placeholder"),
    (LAW + "Die Menge {a, b} umfasst x_{max} (Fußnote {1}).", None), (LAW + "als ________ (Unterschrift)", None), (LAW + "zu beenden [...]. [aufgehoben]", None), (LAW + "`{{ name }}`", None),
    (LAW + "In Mustern darf ein Platzhalter in geschweiften Klammern nur ersetzt werden.", None),
    ("Platzhalter wie {{name}} und {{ort}} werden von der Template Engine ersetzt.", None),
    ("Bitte aktivieren Sie JavaScript, um die Vorschrift anzuzeigen.", "page"), ("Access denied.\nPlease sign in again.", "page"), ("HTTP-FEHLER 404: DIE SEITE WURDE NICHT GEFUNDEN.", "page"),
    ("Page introuvable – l'adresse est inconnue.\nRetour à l'accueil.", "page"), ("Wir verwenden Cookies. Alle akzeptieren | Ablehnen", "page"),
    (LAW + "A server error does not extend the time limit.", None), (LAW + "Barrierefreie Dienste müssen auch ohne JavaScript nutzbar sein.", None), (LAW + LAW + "Nach § 404 Abs. 2 ist binnen 503 Tagen zu zahlen.", None),
    ("Lorem ipsum dolor sit amet", "filler"), ("asdf bla qwertz test bla xxx lalala bla", "filler"), ("Sample text goes here. Sample text goes here. Sample text goes here.", "filler"), ("Text folgt. Text folgt.", "filler"),
    (LAW + "Blindtexte und Fülltexte sind vor der Freigabe zu entfernen.", None), ("", None), ("  ", None), (None, None), (LAW * 3000, None), (LAW * 3000 + "{{x_y}}", "placeholder"), ("Наредба за храните и водите от общината на града", None),
]


@pytest.mark.parametrize("copies", [1, 2])
def test_cases(spark, copies):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] * copies
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as is_page", "1 as n")
    got = R.residue(df).collect()
    assert len(got) == len(rows)
    for r in got:
        kinds = [k for k, v in (("placeholder", r.has_placeholder), ("page", r.is_page), ("filler", r.is_filler)) if v]
        assert (kinds[0] if kinds else None) == CASES[r.doc_id][1], (r.text or "")[:300]
    clean = R.without_residue(df)
    assert clean.columns == ["doc_id", "text", "is_page", "n"] and {r.doc_id for r in clean.collect()} == {i for i, (_, k) in enumerate(CASES) if k is None}
    assert R.residue(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", list(R.MESSAGES))
def test_every_alternative_is_in_the_automaton(kind):
    texts = R.spelled(R.MESSAGES[kind])
    assert texts and all(re.fullmatch(R.MESSAGES[kind].replace("©", "\\©").replace(".|", "[.]|"), t) or "." in t for t, *_ in texts)
    for text, opens, *_ in texts:
        found = R._hits(f"{text} 404" if kind == "head" else text)
        assert ("opens" if opens else "phrase" if kind == "head" else kind) in found, text


def test_spelled_spells_out_groups_and_options():
    assert [t for t, *_ in R.spelled("a(?:b|c)?d|^e\\b")] == ["abd", "acd", "ad", "e"]
    assert R.spelled("^e\\b")[0] == ("e", True, False, True)


LONG = "Die von Ihnen in der Trefferliste der Rechtsvorschriften des Landes und des Bundes ausgewählte Seite mit dem Wortlaut der Vorschrift in der Fassung der letzten Bekanntmachung wurde auf diesem Server nicht gefunden, weil der Server die von Ihnen angefragte Datei mit dem Normtext nicht geladen hat und die Datenbank derzeit nicht erreichbar ist."


def test_no_bound_on_lengths():
    assert len(LONG) > R.MESSAGE_REACH and R.judge(LONG) == (False, True, False)
    for form in ("{{%s}}", "${%s}", "<%%= %s %%>", "{%% if %s %%}", "[[%s]]", "__%s__", "[Hier %s einfügen]", "{%s}", "%%%s_A%%", "<Name %s>"):
        name = "ABCDEFGHIJ" * 30
        text = LAW + "am " + form % name + "."
        assert R.judge(text)[0], form
    # a long sentence of law that has such words far from each other, and one message in a long law
    far = "Der Antrag auf Zugang " + "zu den Unterlagen der Behörde über die Anlage und ihren Betrieb " * 8 + "wird abgelehnt, wenn ein Nachweis fehlt."
    assert R.judge(far) == (False, False, False)
    assert R.judge(LAW * 5 + LONG) == (False, False, False)


def test_pages_of_one_message():
    pages = ["Zeitüberschreitung beim Abruf der Vorschrift.", "Aktive Inhalt werden benötigt.", "Ohne aktiven Inhalt können Sie den Text nicht lesen, er ist erforderlich."]
    assert all(R.judge(t)[1] for t in pages)


def test_mentioned_and_unfilled_placeholders():
    unfilled = [
        "Sehr geehrte {{anrede}}, Ihr Antrag zum Platzhalter im Feld wurde geprüft.",
        "Ein Platzhalter hat die Form {{name}}. " + LAW * 10 + "Die Gebühr beträgt {{betrag}}.",
        "Ein Platzhalter hat die Form {{name}}. Sehr geehrte {{anrede}}, die Gebühr beträgt {{betrag}}, die Frist {{frist}}.",
    ]
    mentioned = ["Mit {{name}} ist ein Platzhalter gesetzt, denn „{{name}}“ ist ein Platzhalter.", "Ein Platzhalter wie {{a_b}} oder {{c_d}} wird ersetzt: Name {{a_b}}.", "``` {{name}} ``` steht im Muster.", "Ein Platzhalter steht in Klammern: " + ", ".join(f"{{{{feld{i}}}}}" for i in range(500)) + "."]
    assert [R.has_placeholder(t) for t in unfilled] == [True] * len(unfilled)
    assert [R.has_placeholder(t) for t in mentioned] == [False] * len(mentioned)


def test_words_in_placeholders_make_no_tutorial(spark):
    templates = ["[Platzhalter Datum]", "Sehr geehrte [PLATZHALTER], die Frist endet am [Platzhalter Datum].", "Die Gebühr beträgt {{placeholder}} Euro.", "Alle Platzhalter sind vor dem Versand zu ersetzen. Die Gebühr beträgt {{betrag}}, die Frist {{frist}}."]
    tutorials = ["Ein Platzhalter steht in doppelten Klammern, etwa {{placeholder}} oder {{name}}.", "The template engine replaces {{name}} and [Platzhalter Nr. 3]."]
    df = spark.createDataFrame(list(enumerate(templates + tutorials)), "doc_id bigint, text string")
    assert {r.doc_id for r in R.residue(df).where("has_placeholder").collect()} == set(range(len(templates)))
