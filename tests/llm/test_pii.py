import re

import pytest

from basketflow.llm import pii, queries
from tests.llm.conftest import SF_DIR

EMAIL = r"[A-Za-z0-9][\w.%+-]*@[\w-]+(?:\.[\w-]+)+"
TEXTS = [
    (1, "Mr John Smith and Mrs Anna Smith met Mr. Smith. Mail John.Smith@Shop.example.com or john.smith@shop.example.com"),
    (2, "call +1 (988) 555-2485 or +1 988 555 2485 from 42.144.35.254, card 4041894974608795 / 4041 8949 7460 8795."),
    (3, "Госпожа Анна Петрова и Господин Иван Петров; Mrs ANNA Smith"), (4, None), (5, ""), (6, "nothing 1.2.3 here"),
    (7, "a@b.co a@b.co 255.255.255.255 999.1.1.1 1.2.3.4.5"), (8, "Herr Müller-Lüdenscheidt, Señora Ñusta Gómez"),
    (1, "Mr John Smith again"), (None, "x mail8@example.com"), (9, "y " * 20_000 + "z@example.org"),
]


def replaced(docs, pairs, key="k"):
    return pii.replace_mentions(docs(pairs), key).collect()


def luhn(digits):
    total = sum(sum(divmod(int(d) * (2 if k % 2 else 1), 10)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def test_format_and_coreference(docs, shared):
    rows = {r.text[:12] if r.doc_id == 1 else r.doc_id: r for r in replaced(docs, TEXTS)}
    assert len(replaced(docs, TEXTS)) == len(TEXTS)
    one = next(r.text for r in replaced(docs, TEXTS) if r.doc_id == 1 and "met" in r.text)
    m = re.fullmatch(r"Mr (\w+) (\w+) and Mrs (\w+) (\w+) met Mr\. (\w+)\. Mail (\S+) or (\S+)", one)
    assert m[2] == m[4] == m[5] and m[1] != m[3] and m[1].endswith("n") and m[3].endswith("na")
    assert m[6] == m[7] and m[6].endswith(".com") and not {"John", "Smith", "Anna"} & set(m.groups())
    two = rows[2].text
    phones, cards = re.findall(r"\+[\d ()-]+\d", two), re.findall(r"(?:\d{4} ?){4}", two)
    assert [re.sub(r"\d", "9", p) for p in phones] == ["+9 (999) 999-9999", "+9 999 999 9999"]
    assert len({re.sub(r"\D", "", p) for p in phones}) == 1 and phones[0].startswith("+1 ")
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and luhn(re.sub(r"\D", "", cards[0]))
    assert not any(x in two for x in ("555-2485", "42.144.35.254", "4041894974608795", "4041 8949"))
    three = rows[3].text
    m = re.fullmatch(r"Госпожа (\w+) (\w+) и Господин (\w+) (\w+); Mrs (\w+) (\w+)", three)
    assert all(re.fullmatch("[а-яА-Я]+", m[k]) for k in (1, 2, 3, 4)) and m[5].isupper() and m[5].isascii()
    assert rows[4].text is None and rows[5].text == "" and rows[6].text == "nothing 1.2.3 here"
    assert "999.1.1.1 1.2.3.4.5" in rows[7].text and rows[7].n_mentions == 3


def test_keyed_and_repeatable(docs, shared):
    a, b, c = (sorted((repr(r) for r in replaced(docs, TEXTS, k))) for k in ("k", "k", "other"))
    assert a == b and a != c


def test_collisions_are_resolved(docs, shared, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {k: v[:2] for k, v in pii.SYLLABLES.items()})
    people = [f"{chr(65 + i)}{chr(97 + j)}x" for i in range(6) for j in range(8)]
    rows = replaced(docs, [(i, f"Mr {p}") for i, p in enumerate(people)])
    new = [r.text for r in rows]
    assert len(set(new)) == len(people) and not {f"Mr {p}" for p in people} & set(new)


def test_query_on_real_table(spark, shared, real):
    got = queries.op1_pii_surrogates(spark, SF_DIR)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {r.doc_id: r for r in got.collect()}
    pairs = {}
    for i, text in real:
        old, new = re.findall(EMAIL, text or ""), re.findall(EMAIL, rows[i].text or "")
        assert len(old) == len(new) and not set(old) & set(new)
        for x, y in zip(old, new):
            assert pairs.setdefault(x.lower(), y.lower()) == y.lower()
        if not rows[i].n_mentions:
            assert rows[i].text == text
        elif not re.search(pii.PATTERNS["person"].replace(r"\p{Lu}", "[A-Z]").replace(r"\p{L}", "[a-z]"), text):
            assert re.sub(r"[a-z0-9]", "", rows[i].text.lower()) == re.sub(r"[a-z0-9]", "", text.lower())
    assert len(set(pairs.values())) == len(pairs) > 3


def test_empty_table(docs, shared):
    out = pii.replace_mentions(docs([]), "k")
    assert out.count() == 0 and out.columns == [*docs([]).columns, "n_mentions"]


FORMS = ["Mr John Paul Smith", "Frau Anna Müller-Schmidt", "Mr. J. Smith", "Dr Eva Brown", "Frau Prof. Dr. Lena Graf",
         "Herr Ludwig von Beethoven", "555-123-4567", "(555) 123-4567", "1-555-123-4568", "030 1234567", "(030) 1234 5678",
         "01 23 45 67 89", "378282246310005", "3782 822463 10005", "2221000000000009", "4222222222222", "6304000000000000000"]


def test_each_form_is_replaced_whole(docs, shared):
    rows = {r.doc_id: r for r in replaced(docs, [(i, f"see {form}, then") for i, form in enumerate(FORMS)])}
    out = {form: rows[i].text.removeprefix("see ").removesuffix(", then") for i, form in enumerate(FORMS)}
    assert all(rows[i].n_mentions == 1 for i in range(len(FORMS)))
    keep = {"Mr", "Frau", "Dr", "Prof", "Herr", "von"}
    for form, new in out.items():
        old_parts, new_parts = re.findall(r"[^\W\d_]+", form), re.findall(r"[^\W\d_]+", new)
        assert len(old_parts) == len(new_parts)
        assert all((a == b) == (a in keep) for a, b in zip(old_parts, new_parts))
        if form[-1].isdigit():
            assert new != form and re.sub(r"\d", "9", new) == re.sub(r"\d", "9", form)
    assert all(luhn(re.sub(r"\D", "", out[f])) for f in FORMS[-5:])
    assert out["Mr John Paul Smith"].split()[-1] == out["Mr. J. Smith"].split()[-1]
    assert re.sub(r"\D", "", out["378282246310005"]) == re.sub(r"\D", "", out["3782 822463 10005"])


def test_other_numbers_stay(docs, shared):
    texts = ["id 1234567890123456", "on 2024-01-15 10:30", "on 01.02.2024", "sum 1,234,567.89", "x 4222222222223 y"]
    rows = replaced(docs, list(enumerate(texts)))
    assert sorted(r.text for r in rows) == sorted(texts) and not any(r.n_mentions for r in rows)


def test_long_names_domains_and_words(docs, shared):
    """Nothing recurses with the length of a mention, and a run of letters is read once."""
    name = "Mr " + " ".join(f"Ab{chr(97 + k % 26)}" for k in range(3000))
    pairs = [(1, name), (2, "x@" + ".".join(["lab"] * 5000) + ".com"), (3, "a" * 50_000), (4, "a." * 25_000), (5, "a--" * 20_000 + "b@c.de"),
             (6, "Dr " * 3000 + "Who")]
    rows = {r.doc_id: r for r in replaced(docs, pairs)}
    assert len(rows[1].text.split()) == 3001 and "Abc" not in rows[1].text.split() and rows[1].n_mentions == 1
    assert not rows[2].text.startswith("x@lab.") and rows[2].n_mentions == 1
    assert rows[3].text == "a" * 50_000 and rows[4].text == "a." * 25_000
    assert rows[5].n_mentions == 1 and not rows[5].text.endswith("b@c.de")
    assert rows[6].text.startswith("Dr Dr") and not rows[6].text.endswith("Who")


def test_more_units_than_surrogates_of_their_format(docs, shared):
    """450 one-letter addresses of one-letter domains: surrogates grow, and the rounds end."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.de" for a in letters for b in letters][:450]
    rows = {r.doc_id: r.text for r in replaced(docs, list(enumerate(mails)))}
    assert len(set(rows.values())) == 450 and not set(rows.values()) & set(mails)
    assert all(re.fullmatch(r"[a-z]+@[a-z]+\.de", t) for t in rows.values())
    # one domain, one surrogate; one local part, one surrogate
    parts = [{}, {}]
    for k, mail in enumerate(mails):
        for known, old, new in zip(parts, mail.split("@"), rows[k].split("@")):
            assert known.setdefault(old, new) == new
    for known in parts:
        assert len(set(known.values())) == len(known)


def test_one_person_one_surrogate_whatever_the_title(docs, shared):
    rows = {r.doc_id: r.text for r in replaced(docs, [
        (1, "Mr John Smith"), (2, "Dr John Smith"), (3, "Prof. Anna Smith"), (4, "Mrs Anna Smith"), (5, "Dr Kim Lee")])}
    assert rows[1].removeprefix("Mr ") == rows[2].removeprefix("Dr ")
    assert rows[3].removeprefix("Prof. ") == rows[4].removeprefix("Mrs ")
    assert len({t.split()[-2] for t in rows.values()}) == 3


def test_domains_and_country_codes_are_kept_together(docs, shared):
    codes = ["1", "7", "20", "33", "49", "351", "380", "420", "998", "852"]
    rows = {r.doc_id: r.text for r in replaced(docs, [(k, f"+{c} 555 123 4567") for k, c in enumerate(codes)]
                                               + [(90, "john@x.com"), (91, "jane@x.com"), (92, "JANE@X.COM")])}
    for k, c in enumerate(codes):
        assert rows[k].startswith(f"+{c} ") and rows[k] != f"+{c} 555 123 4567"
    assert rows[90].split("@")[1] == rows[91].split("@")[1] and rows[90] != rows[91]
    assert rows[92].lower() == rows[91]


def test_clashing_names(spark, shared):
    docs = spark.createDataFrame([(1, "Mr Smith", "a", "b", "c", "d", 5)], "doc_id long, text string, _new string, _text_key string, text_key string, new_of string, raw int")
    row = pii.replace_mentions(docs, "k").first()
    assert (row["_new"], row["_text_key"], row["text_key"], row["new_of"], row["raw"]) == ("a", "b", "c", "d", 5)
    assert row["text"].startswith("Mr ") and row["text"] != "Mr Smith"


def test_rows_with_candidates_are_looked_for_twice_only(spark, shared):
    """Once to write them, once to pass on the others; other columns pass through, also those without a type."""
    docs = spark.createDataFrame([(1, "Mr John Smith"), (2, "plain"), (3, None)], "doc_id long, text string").selectExpr(
        "*", "null AS nothing")
    out = pii.replace_mentions(docs, "k")
    assert [(r.doc_id, r.n_mentions, r.nothing) for r in out.orderBy("doc_id").collect()] == [(1, 1, None), (2, 0, None), (3, 0, None)]
    filters = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RLIKE" in x and "Filter" in x]
    assert len(filters) == 1
