import random

import pytest

from normwerk.llm import canonical as C

LAWS = [
    ("kaaurfv", "Verordnung zur Durchführung der Kalkausgleichsprüfung", "Kalkausgleichsprüfungsverordnung", "KaaurFV", None),
    ("ropcsg", "Gesetz zur Neuordnung der Röhrenplanungsverteilung", "Röhrenplanungsverteilungsgesetz", "RopcSG", None),
    ("ropcsg_dv", "Durchführungsbestimmungen zum Erlass „Röhrenplanungsverteilungsgesetz“", "Röhrenplanungsverteilungsgesetz-Durchführungsbestimmungen", "RopcSG-DB", None),
    ("eu1", "Verordnung (EU) 2032/1987 über die Leitungsgebietszulassung", "Leitungsgebietszulassungsverordnung", "LegupSV", "2032/1987"),
]
CASES = {
    "kaaurfv": "kaaurfv", " KaaurFV 2031": "kaaurfv", "§ 4 KaaurFV.": "kaaurfv", "KALK-AUSGLEICHSPRUEFUNGSVERORDNUNG idgF": "kaaurfv", "der Kаlkausgleichsprüfungsverordnung": "kaaurfv",
    "VO z. Durchf. der Kalk ausgleichspruefung": "kaaurfv", "Kalkausgleichsprüfung, Verordnung zur Durchführung der (neue Fassung)": "kaaurfv", "des Röhrenplanungsveteilungsgesetzes": "ropcsg",
    "Röhrenplanungsverteilungsgesetz-Durchf.best.": "ropcsg_dv", "RopcSG-DB": "ropcsg_dv", "Durchführungsbestimmungen zum Erlass Röhrenplanungsverteilungsgesetz": "ropcsg_dv",
    "VO(EU)Nr. 2032 / 1987": "eu1", "2032/1987/EU": "eu1", "Leitungsgebietszulassungsverordnung": "eu1", "VO (EU) 2032/19877 über die Leitungsgebietszulassung": "eu1", "VO (EU) 2031/1": None, "Marleitungsgebietszulassungsverordnung": None,
    "Kalkausgleichserhebungsverordnung": None, "Kesselplanungsverteilungsgesetz": None, "k. A.": None, "-": None, "": None, "Ges­etz zur Neuordnung der Röhrenplanungsverteilung": "ropcsg",
}


def test_names(spark):
    rows = [(i, n) for i, n in enumerate(CASES)] + [(500, None), (None, "KaaurFV"), (0, "kaaurfv"), (501, "x" * 5000)]
    names = spark.createDataFrame(rows, "name_id bigint, name string").selectExpr("*", "'x' as core", "1 as law_key")
    laws = spark.createDataFrame(LAWS, "law_key string, title string, short_title string, abbreviation string, act_number string")
    got = {r.name_id: r for r in C.map_names(names, laws).collect()}
    assert {CASES_KEY: got[i].law_key for i, CASES_KEY in enumerate(CASES)} == CASES
    assert got[500].method == got[501].method == "none" and len(got) == len(CASES) + 2
    assert C.map_names(names.limit(0), laws).count() == 0
    assert {r.method for r in C.map_names(names, laws.limit(0)).collect()} == {"none"}


@pytest.mark.parametrize("seed,threshold,broadcast", [(1, 0.4, 500_000), (2, 0.7, 0)])
def test_join_is_exact(spark, monkeypatch, seed, threshold, broadcast):
    monkeypatch.setattr(C, "MOST_GRAMS", broadcast)
    rng = random.Random(seed)
    side = lambda n: [(str(i), rng.sample("abcdefghijklmnop", rng.randint(1, 9))) for i in range(n)]
    left, right = side(120), side(60)
    got = {(r.l, r.r): r.jaccard for r in C.similarity_join(spark.createDataFrame(left, "l string, grams array<string>"), spark.createDataFrame(right, "r string, grams array<string>"), threshold).collect()}
    want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in left for b, y in right}
    assert got == {k: v for k, v in want.items() if v >= threshold}


def test_distance():
    def slow(a, b, anywhere):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                if i == 0:
                    table[i][j] = 0 if anywhere else j
                elif j == 0:
                    table[i][j] = i
                else:
                    table[i][j] = min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                    if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                        table[i][j] = min(table[i][j], table[i - 2][j - 2] + 1)
        return min(table[-1]) if anywhere else table[-1][-1]

    rng = random.Random(4)
    for _ in range(600):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(2))
        assert C.distance(a, b) == slow(a, b, False) and C.distance(a, b, True) == slow(a, b, True)


def test_two_edits_are_found_below_the_jaccard_threshold(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnop"

    def edited(text):
        for _ in range(2):
            i, kind = rng.randrange(len(text) - 1), rng.randrange(4)
            text = {0: text[:i] + text[i + 1 :], 1: text[:i] + rng.choice(letters) + text[i:], 2: text[:i] + rng.choice(letters) + text[i + 1 :], 3: text[:i] + text[i + 1] + text[i] + text[i + 2 :]}[kind]
        return text

    entries = list({"".join(rng.choices(letters[: rng.choice([2, 16])], k=rng.choice([8, 9, 11, 13, 15, 17, 21, 39, 40, 41, 42, 44]))) for _ in range(80)} | {"ab" * 300})
    cores = list({edited(e) for e in entries for _ in range(3)} | set(entries[:20]) | {"x" * 5000, "ab" * 2500, "abc"})
    grams = lambda c: sorted({f"  {c} "[i : i + 3] for i in range(len(c) + 1)})
    left = spark.createDataFrame([(c, grams(c), len(c)) for c in cores], "l string, grams array<string>, letters int")
    right = spark.createDataFrame([(c, grams(c), len(c)) for c in entries], "r string, grams array<string>, letters int")
    by_grams = {(r.l, r.r) for r in C.similarity_join(left, right, C.THRESHOLD).collect()}
    got = {(r.l, r.r) for r in C.candidates(left, right, C.THRESHOLD).collect()}
    want = {(a, b) for a in cores for b in entries if abs(len(a) - len(b)) <= 2 and C.distance(a, b) <= 2}
    assert want - by_grams and want | by_grams <= got


def test_short_words_and_long_abbreviations(spark):
    laws = spark.createDataFrame([("a", "Uhr-Öl-Amt", None, None, None), ("b", None, None, "SehrlangeabkuerzungVO", None), ("c", None, None, "X", None)], "law_key string, title string, short_title string, abbreviation string, act_number string")
    names = spark.createDataFrame([(1, "Uhr Öl Amt"), (2, "sehrlangeabkürzungvo"), (3, "x"), (4, "Uhr")], "name_id bigint, name string")
    assert {r.name_id: r.law_key for r in C.map_names(names, laws).collect()} == {1: "a", 2: "b", 3: "c", 4: None}


def test_names_two_edits_away(spark):
    laws = spark.createDataFrame([("ebp", None, "Erntebauprüfungsgesetz", None, None), ("uwh", None, "Uferwegehaftungsgesetz", None, None)], "law_key string, title string, short_title string, abbreviation string, act_number string")
    names = spark.createDataFrame([(1, "Enrtebaupürfungsgesetz"), (2, "Ufrewegehatfungsgesetz"), (3, "Uxxxwegehaftungsgesetz")], "name_id bigint, name string")
    assert {r.name_id: r.law_key for r in C.map_names(names, laws).collect()} == {1: "ebp", 2: "uwh", 3: None}
