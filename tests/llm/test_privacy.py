"""Surrogates: what is found, what stays, and that nothing merges."""

import re

import pytest
from cases import empty
from pyspark.sql import functions as F

from callmart.llm import surrogates

TEXTS = {
    1: "Write to anna.k7@mail4.example.com or ANNA.K7@MAIL4.EXAMPLE.COM, not to bob@mail4.example.com.",
    2: "Call +1 (974) 555-3436 or +1 974 555 3436 now; 10.20.30.40 and 010.20.30.40 are one host.",
    3: 'token = "9b8c45435718dcc700c184a7e303cdc64c6a8f7f" and TOKEN = "9B8C45435718DCC700C184A7E303CDC64C6A8F7F"!!',
    4: "Card 4539578763621486, again 4539 5787 6362 1486, and 4225039295678253.",
    5: "Mr. John Smith met Mrs. Jane Smith. Sir John Smith left. Herr Müller, Госпожа Анна Петрова, Κύριος Νίκος Παππάς.",
    6: "Nothing private: version 3.0, CC BY-NC 4.0, 12345 and 1999.",
    7: "",
    8: None,
    9: "x" * 30_000 + "@" + "9" * 30_000 + " a@b.example.com",
    10: "a.b.c@d.example.org" * 2,
    11: "éou.90@mail2.example.com и почта.5@mail2.example.net",
}


@pytest.fixture(scope="module")
def changed(spark):
    rows = [(i, t, None if t is None else len(t), 9) for i, t in TEXTS.items()]
    rows += [(1, TEXTS[1], len(TEXTS[1]), 9), (None, TEXTS[2], len(TEXTS[2]), 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, place int").repartition(3)
    found = surrogates.replace_private(docs, "key")
    assert found.columns == ["doc_id", "text", "n_chars", "place", "n_entities"]
    found = found.collect()
    assert len(found) == len(rows)
    return {r.doc_id: r for r in found}


def test_nothing_private_is_left_and_the_rest_stays(changed):
    for i in (6, 7, 8):
        assert changed[i].text == TEXTS[i] and changed[i].n_entities == 0
    assert changed[1].n_entities == 3 and changed[2].n_entities == 4 and changed[3].n_entities == 2
    outside = re.split(surrogates.PATTERNS["email"].replace("++", "+").replace(r"\p{L}\p{N}", r"\w"), TEXTS[1])
    assert all(part in changed[1].text for part in outside)
    for i in (1, 2, 3, 4, 5, 11):
        for word in re.findall(r"[\w.+@-]{5,}", TEXTS[i]):
            if re.search(r"\d{2}|@|Smith|Müller|Петрова|Παππάς", word):
                assert word not in changed[i].text, word
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in changed.values())


def test_format_and_coreference(changed):
    a, upper, b = re.findall(r"[\w.]+@[\w.]+\w", changed[1].text)
    assert upper == a.upper() and a.split("@")[1] == b.split("@")[1] and a != b
    assert re.fullmatch(r"[a-z]{4}\.[a-z]\d@[a-z]+\.example\.com", a)
    numbers = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4}) now; ([\d.]+) and ([\d.]+) are", changed[2].text)
    assert numbers.groups()[:3] == numbers.groups()[3:6] and numbers[7] == numbers[8]
    assert changed[None].text == changed[2].text
    low, high = re.findall(r'"([0-9a-fA-F]{40})"', changed[3].text)
    assert high == low.upper()
    card, spaced, other = re.search(r"Card (\d{16}), again (\d{4} \d{4} \d{4} \d{4}), and (\d{16})\.", changed[4].text).groups()
    assert spaced.replace(" ", "") == card and card[0] == "4" and other[0] == "4" and luhn(card) and luhn(other)


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def test_names_keep_gender_and_script(changed):
    found = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+)\. Sir (\w+) (\w+) left\. Herr (\w+), Госпожа ([А-Яа-яё]+) [А-Яа-яё]+, Κύριος ([^ ]+) [^ ]+\.",
        changed[5].text,
    )
    first = surrogates.FIRST_NAMES
    assert found[1] in first["latin", "m"] and found[3] in first["latin", "f"]
    assert (found[5], found[6]) == (found[1], found[2])
    assert found[8] in first["cyrillic", "f"] and found[9] in first["greek", "m"]


def test_distinct_entities_stay_distinct(spark):
    """More names than surrogates of one attempt, and addresses that fill a good part of their space."""
    names = spark.range(40_000).select(F.lit("name").alias("kind"), F.format_string("m:n%d", "id").alias("normal"))
    hosts = spark.range(20_000).select(
        F.lit("ip").alias("kind"), F.concat_ws(".", F.lit("1"), F.lit("2"), (F.col("id") / 256).cast("int"), F.col("id") % 256).alias("normal")
    )
    single = spark.createDataFrame([("email", f"{c}@x.com") for c in "abcdefghijklmnopqrstuvwxyz"], "kind string, normal string")
    entities = names.unionByName(hosts).unionByName(single).unionByName(single)
    found = surrogates.surrogate_table(entities, "key").collect()
    assert len(found) == 60_026 == len({(r.kind, r.normal) for r in found}) == len({(r.kind, r.surrogate) for r in found})
    assert not {(r.kind, r.normal) for r in found} & {(r.kind, r.surrogate) for r in found}
    other = {(r.kind, r.normal): r.surrogate for r in surrogates.surrogate_table(single, "other key").collect()}
    mine = {(r.kind, r.normal): r.surrogate for r in surrogates.surrogate_table(single, "key").collect()}
    assert set(other) == set(mine) and other != mine


def test_no_rows(spark):
    assert surrogates.replace_private(empty(spark), "key").count() == 0


FORMS = [
    "+33 6 12 34 56 78", "+33 1 42 68 53 00", "+49 30 12 34 56 78", "+44 (0)20 7946 0958", "+1 974 555 3436", "+19745553436",
    "(743) 555-3824", "743-555-3824", "1-743-555-3824", "06 12 34 56 78", "020 7946 0958", "(030) 1234 5678",
    "3782 822463 10005", "4539 5787 6362 1486",
    "Mr. John McDonald", "Mrs. Anna Smith-Jones", "Ms. Maria Garcia Lopez", "Mr. O'Neil", "Dr. John Smith", "Mr. J. Smith", "Herr Jan van der Berg",
    "8.8.8.8", "1.2.3.4", "a1b2c3d4" * 4, "abcdefab" * 4, "DEADBEEF" * 4,
]


def test_each_form_is_found_whole(spark):
    """Alone, with nothing else in the text that hints at private data, and in a sentence."""
    rows = [(2 * i + k, t) for i, x in enumerate(FORMS) for k, t in enumerate((x, f"so, {x}, or ({x}); then {x}."))]
    found = {r.doc_id: r for r in surrogates.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for i, form in enumerate(FORMS):
        alone, inside = found[2 * i], found[2 * i + 1]
        assert alone.n_entities == 1 and inside.n_entities == 3, form
        assert inside.text == f"so, {alone.text}, or ({alone.text}); then {alone.text}.", form
        for part in re.findall(r"\w{3,}", form.split(" ", 1)[-1] if form[0] in "MDH" else ""):
            assert part not in alone.text, form
        if form[0] in "+(0123456789" and "." not in form and not form[1].isalpha():
            assert re.sub("[0-9]", "0", alone.text) == re.sub("[0-9]", "0", form) and alone.text != form
    assert found[0].text.startswith("+33 6") and found[4].text.startswith("+49 ")


def test_what_only_looks_private_stays(spark):
    texts = ["in 2019-2020 about 200, 300 and 4000", "01.02.2024 10:30", "Smith-like, version 1.2.3", "+1 and +25 degrees", "10 - 12, 1 000 000"]
    docs = spark.createDataFrame(list(enumerate([*texts, "Mr. Smith's dog and Mr. Smith I saw"])), "doc_id long, text string")
    found = {r.doc_id: r for r in surrogates.replace_private(docs, "key").collect()}
    assert [found[i].text for i in range(len(texts))] == texts
    name = re.fullmatch(r"Mr\. (\w+)'s dog and Mr\. (\w+) I saw", found[len(texts)].text)
    assert name[1] == name[2] != "Smith"
