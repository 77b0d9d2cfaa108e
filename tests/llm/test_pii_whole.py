"""Personal data in forms that the tables of the driver do not hold."""

import re

from recmill.llm import pii


def replaced(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = pii.pseudonymise(docs, "k", count_col="n").orderBy("doc_id").collect()
    return [(r.text, r.n) for r in rows]


def test_secret_without_digits(spark):
    secret = "correcthorsebatterystaple"
    texts = [f"The password: {secret} is mine", f"The password: {secret} is mine, since 2024", f'API-Key = "{secret}"', "a secret: none"]
    bare, dated, quoted, none = replaced(spark, *texts)
    assert bare[1] == dated[1] == quoted[1] == 1 and secret not in bare[0] + dated[0] + quoted[0]
    assert dated[0] == bare[0] + ", since 2024" and re.fullmatch('API-Key = "[a-z]{25}"', quoted[0])
    assert none == ("a secret: none", 0)


def test_names_of_several_words_and_their_repeats(spark):
    texts = [
        "Dr. Martin Luther King spoke. Martin Luther King and King agree; Kings do not, nor does Barking.",
        "Mr. John F. Kennedy, Dr. J.F. Kennedy and Mr. J Kennedy",
        "Mr. Smith left. Smith's dog, a Smith-like one, and Mr. Smith's cat stay with J. Smith.",
        "Smith is no person here, 2024",
    ]
    king, kennedy, smith, none = replaced(spark, *texts)
    found = re.fullmatch(r"Dr\. (\w+ \w+ (\w+)) spoke\. (\w+ \w+ \w+) and (\w+) agree; Kings do not, nor does Barking\.", king[0])
    assert found[1] == found[3] and found[2] == found[4] and king[1] == 3
    assert not re.search(r"\b(Martin|Luther|King)\b", king[0])
    found = re.fullmatch(r"Mr\. (\w+) (\w)\. (\w+), Dr\. (\w)\.(\w)\. (\w+) and Mr\. (\w) (\w+)", kennedy[0])
    assert found[1] in pii.GIVEN["male latin"] and found[3] == found[6] == found[8] != "Kennedy" and kennedy[1] == 3
    assert {found[i] for i in (2, 4, 5, 7)} == {found[3][0]}
    found = re.fullmatch(r"Mr\. (\w+) left\. (\w+)'s dog, a (\w+)-like one, and Mr\. (\w+)'s cat stay with (\w)\. (\w+)\.", smith[0])
    assert {found[i] for i in (1, 2, 3, 4, 6)} == {found[1]} and found[1] != "Smith" and smith[1] == 5
    assert none == (texts[3], 0)


PHONES = [
    "(555) 123-4567", "555-123-4567", "555.123.4567", "1-800-555-1234", "+33 6 12 34 56 78", "+34 612 34 56 78", "+7 (495) 123-45-67",
    "+45 12 34 56 78", "+65 6123 4567", "+36 1 234 5678", "+46 8 123 456 78", "06 12 34 56 78", "020 7946 0958", "(020) 7946 0958",
    "0171 1234567", "612 34 56 78", "+1 (017) 555-7713", "+10175557713",
]
NO_PHONES = ["300.1.1.1", "1.2.3.4.5", "2024-01-02 10:20", "12-34-5678-1234-567-890", "0.5 100 200", "+5 10 20", "100 20 30", "1234567890", "x555-123-4567"]


def test_phones_of_many_formats(spark):
    for text, (new, n) in zip(PHONES, replaced(spark, *[f"Call {p}, or {p}." for p in PHONES])):
        one, two = re.fullmatch(r"Call (.*), or (.*)\.", new).groups()
        assert n == 2 and one == two != text, text
        assert re.sub(r"\d", "0", one) == re.sub(r"\d", "0", text), text
    home, abroad = replaced(spark, "+44 (0)20 7946 0958", "+44 20 7946 0958")
    assert home == abroad and home[1] == 1
    assert replaced(spark, *NO_PHONES) == [(text, 0) for text in NO_PHONES]


def test_cards_of_other_groupings(spark):
    amex, diners, plain, wrong = replaced(spark, "3782 822463 10005", "3056-930902-5904", "378282246310005", "3782 822463 10006")
    assert amex[1] == diners[1] == 1 and re.fullmatch(r"37\d\d \d{6} \d{5}", amex[0]) and amex[0] != "3782 822463 10005"
    assert re.fullmatch(r"30\d\d-\d{6}-\d{4}", diners[0]) and diners[0] != "3056-930902-5904"
    assert plain[0] == amex[0].replace(" ", "") and wrong == ("3782 822463 10006", 0)
