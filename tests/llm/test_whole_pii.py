"""Phones, cards and titles in their other usual forms."""

import re

from plumbline.llm import pii


def test_national_phones_cards_and_titles(spark):
    texts = [
        "a (663) 555-6869 b 663-555-6869 c 020 7946 0958 d +33 1 23 45 67 89 e 01 23 45 67 89.",
        "f 3782 822463 10005 g 378282246310005 h 4111 1111 1111 1111 i 4111-1111-1111-1111 j 4111111111111111",
        "k +44 20 7946 0958 l +442079460958", "Dr. Smith, Prof. Dr. Ann Jones, Herr Dr. Weber", "in 2024-10-11, 1,234.50 and 100 200 3000",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.replace(rows, kinds="kinds").collect()}
    m = re.fullmatch(r"a (\(\d{3}\) \d{3}-\d{4}) b (\d{3}-\d{3}-\d{4}) c (0\d\d \d{4} \d{4}) d (\+33 \d( \d\d){4}) e (0\d( \d\d){4})\.", got[0]["text"])
    digits = lambda t: re.sub(r"\D", "", t)
    assert m and got[0]["kinds"] == ["phone"] * 5 and digits(m[1]) == digits(m[2]) and not any(p in got[0]["text"] for p in ("555-6869", "7946 0958", "23 45 67 89"))
    m = re.fullmatch(r"f (3\d{3} \d{6} \d{5}) g (\d{15}) h (\d{4} \d{4} \d{4} \d{4}) i (\d{4}-\d{4}-\d{4}-\d{4}) j (\d{16})", got[1]["text"])
    assert m and digits(m[1]) == m[2] != "378282246310005" and digits(m[3]) == digits(m[4]) == m[5] != "4111111111111111" and got[1]["kinds"] == ["card"] * 5
    m = re.fullmatch(r"k (\+44 \d\d \d{4} \d{4}) l (\+44\d{10})", got[2]["text"])
    assert m and digits(m[1]) == digits(m[2]) != "442079460958"
    assert re.fullmatch(r"Dr\. \w+, Prof\. Dr\. \w+ \w+, Herr Dr\. \w+", got[3]["text"]) and not re.search("Smith|Jones|Weber", got[3]["text"])
    assert got[4]["text"] == texts[4] and got[4]["kinds"] == []


def test_forms_of_names(spark):
    """Inner capitals, apostrophes, hyphens, initials, three words, capitals; a genitive's s and what follows a name stay."""
    texts = {
        1: ("Mr. McDonald said", r"Mr\. (\w+) said"),
        2: ("Mr. John Michael Smith, then", r"Mr\. (\w+) (\w+) (\w+), then"),
        3: ("Mrs. Smith-Jones and", r"Mrs\. (\w+)-(\w+) and"),
        4: ("Frau Müller-Lüdenscheidt ist", r"Frau (\w+)-(\w+) ist"),
        5: ("Mrs. O'Neill's car", r"Mrs\. (\w+)'s car"),
        6: ("Mr. J. Smith went", r"Mr\. ([A-Z])\. (\w+) went"),
        7: ("MR. SMITH, AND", r"MR\. ([A-Z]+), AND"),
        8: ("Prof. Dr. Anna-Maria Weber (x)", r"Prof\. Dr\. (\w+)-(\w+) (\w+) \(x\)"),
        9: ("г-жа Иванова-Петрова: да", r"г-жа (\w+)-(\w+): да"),
        10: ("Dr. J. R. R. Smith.", r"Dr\. ([A-Z])\. ([A-Z])\. \2\. (\w+)\."),
    }
    private = ("McDonald", "Donald", "John", "Michael", "Smith", "SMITH", "Jones", "Müller", "Lüdenscheidt", "Neill", "Anna", "Maria", "Weber", "Иванова", "Петрова", "J.", "R.")
    rows = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace(rows, key="k", kinds="kinds").collect()}
    found = {}
    for i, (_, form) in texts.items():
        m = re.fullmatch(form, got[i].text)
        assert m and got[i].kinds == ["person"], got[i].text
        assert not any(p in got[i].text.replace("Dr.", "").replace("MR.", "").replace("Mr.", "") for p in private), got[i].text
        found[i] = m.groups()
    # Smith is the same person's name wherever it stands, and in capitals
    smith = found[2][2]
    assert found[3][0] == found[6][1] == found[10][2] == smith and found[7][0] == smith.upper()


def test_numbers_without_a_check_digit_stay(spark):
    """Long numbers that fail the Luhn sum, and those next to letters, are no cards; cards beside them still go."""
    texts = ["a 1700000000000 b", "gb82west12345698765432", "x 9807915762804490 and 4111111111111111, 1234-5678-9012-3456.", "card4111111111111111", "9807915762804490"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace(rows, kinds="kinds").collect()}
    assert [got[i].text for i in (0, 1, 3, 4)] == [texts[i] for i in (0, 1, 3, 4)] and got[0].kinds == []
    m = re.fullmatch(r"x 9807915762804490 and (\d{16}), 1234-5678-9012-3456\.", got[2].text)
    assert m and m[1] != "4111111111111111" and got[2].kinds == ["card"]


def test_long_keys_and_trunk_prefixes(spark):
    texts = ["sk_live_" + "aB3" * 60, "0123456789abcdef" * 9, "xoxb-" + "12-ab" * 40, "call 1-800-555-1234 now"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace(rows).collect()}
    assert re.fullmatch("sk_live_(?:[a-z][A-Z][0-9]){60}", got[0]) and got[0] != texts[0]
    assert re.fullmatch("[0-9a-f]{144}", got[1]) and got[1] != texts[1]
    assert re.fullmatch(r"xoxb-(?:\d\d-[a-z]{2}){40}", got[2]) and got[2] != texts[2]
    assert re.fullmatch(r"call 1-\d{3}-\d{3}-\d{4} now", got[3]) and "555-1234" not in got[3]
