"""Surrogates: distinctness, coreference, formats, edge rows."""

import re

from itemscope.llm import pii

KEY = b"test key"
IBAN = "DE89370400440532013000"


def _run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    out = pii.pseudonymize(df, KEY, **kw)
    assert out.columns[:3] == df.columns
    return [r.text for r in sorted(out.collect(), key=lambda r: r.doc_id)]


def test_formats_and_coreference(spark):
    texts = [
        "mail anna.b7@mail3.example.com now", "MAIL ANNA.B7@MAIL3.EXAMPLE.COM now", "call +1 (377) 555-7713 or +1 377 555 7713",
        "card 4111 1111 1111 1111 and 4111111111111111", "no card 4111111111111112", f"iban {IBAN} or DE89 3704 0044 0532 0130 00",
        "host 97.51.17.173.", "ssn 123-45-6789", "Frau Keller met Anna Keller and Mr. John Smith; JOHN SMITH? Mr SMITH", "г-н Петров и Анна Петрова",
        "王伟先生", "Mary Jones and Mary Brown", None, "", "nothing here", "v6 2001:db8:0:0:0:0:0:1 x",
    ]
    out = _run(spark, texts)
    low = re.search(r"\S+@\S+", out[0])[0]
    assert low != "anna.b7@mail3.example.com" and re.fullmatch(r"[a-z]{4}\.[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com", low)
    assert low.upper() in out[1]
    a, b = re.fullmatch(r"call \+(\d \(\d{3}\) \d{3}-\d{4}) or \+(\d \d{3} \d{3} \d{4})", out[2]).groups()
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "13775557713"
    a, b = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})", out[3]).groups()
    assert a.replace(" ", "") == b != "4111111111111111" and pii.luhn(b)
    n = re.fullmatch(r"no card (\d{16})", out[4])[1]
    assert not pii.luhn(n) and n != "4111111111111112"
    a, b = re.fullmatch(r"iban (DE\d{20}) or (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d)", out[5]).groups()
    assert a == b.replace(" ", "") != IBAN and pii.iban_valid(a)
    assert all(0 < int(x) < 255 for x in re.fullmatch(r"host (\d+)\.(\d+)\.(\d+)\.(\d+)\.", out[6]).groups())
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", out[7]) and "6789" not in out[7]
    m = re.fullmatch(r"Frau (\w+) met (\w+) (\w+) and Mr\. (\w+) (\w+); JOHN SMITH\? Mr (\w+)", out[8])
    assert m[1] == m[3] and m[6] == m[5].upper() and len({m[1], m[5], "Keller", "Smith"}) == 4
    assert _gender(m[2]) == "f" and _gender(m[4]) == "m"
    m = re.fullmatch(r"г-н (\w+) и (\w+) (\w+)", out[9])
    assert all(pii.script_of(x) == "cyrillic" for x in m.groups()) and m[1] != "Петров"
    assert re.fullmatch(r"[一-鿿]{2,3}先生", out[10]) and out[10] != "王伟先生"
    m = re.fullmatch(r"(\w+) (\w+) and (\w+) (\w+)", out[11])
    assert m[1] == m[3] and m[2] != m[4]
    assert out[12] is None and out[13:15] == ["", "nothing here"]
    assert re.fullmatch(r"v6 [0-9a-f:]+ x", out[15]) and "db8" not in out[15]


LEFT = {  # text -> what must be gone, what must stay
    "Mr Xaver Huber called": (["Xaver", "Huber"], ["Mr", "called"]), "Frau Svenja Keller kam": (["Svenja", "Keller"], ["Frau", "kam"]),
    "Mr Richard Brown and Mrs Ursula Weber": (["Richard", "Brown", "Ursula", "Weber"], ["Mr", "Mrs", "and"]),
    "Dr. Tariq Aziz said": (["Tariq", "Aziz"], ["Dr.", "said"]), "MR XAVER HUBER": (["XAVER", "HUBER"], ["MR"]),
    "mr Jan van der Berg went": (["Jan", "Berg"], ["mr", "van der", "went"]), "Prof. J. Kowalski wrote": (["Kowalski", "J."], ["Prof.", "wrote"]),
    "Herr Karl Otto Braun.": (["Karl", "Otto", "Braun"], ["Herr"]), "Mr Smith IBM": (["Smith"], ["IBM"]), "Mrs Brown. She left": (["Brown"], ["She left"]),
    "with Richard Brown there": (["Richard", "Brown"], ["with", "there"]), "Mr and Mrs Weber": (["Weber"], ["Mr and Mrs"]),
    "ring 030 1234567 or 912 345 678": (["1234567", "912 345 678"], ["ring", "or"]), "tel 01 23 45 67 89;": (["23 45 67"], ["tel"]),
    "555 123 4567!": (["123 4567"], ["!"]), "In 2021 100 200 people, miss nothing": ([], ["In 2021 100 200 people, miss nothing"]),
}


def test_literal_names_and_numbers_are_gone(spark):
    for (text, (gone, stay)), out in zip(LEFT.items(), _run(spark, list(LEFT))):
        assert not [x for x in gone if x in out], (text, out)
        assert not [x for x in stay if x not in out], (text, out)


def test_a_number_with_and_without_its_country_is_one(spark):
    out = _run(spark, ["+1 (555) 123-4567", "(555) 123-4567", "+49 30 1234567", "030 1234567"])
    digits = [re.sub(r"\D", "", x) for x in out]
    assert digits[0] == "1" + digits[1] and digits[2][:2] == "49" and digits[3] == "0" + digits[2][2:] and out[0].startswith("+1 (")
    assert "1234567" not in "".join(digits)


def test_names_of_all_genders_are_apart_and_neutral_titles_take_the_known_one(spark):
    people = [f"{t} {g}{c} Xyz" for g in ("Zor", "Quin", "Vex") for c in "abcdefghijklmnopqrst" for t in ("Mr", "Mrs", "Dr")]
    texts = people + ["Mr Bodo Alt", "Dr Bodo Alt"]
    out = _run(spark, texts)
    assert out[-2].split()[1:] == out[-1].split()[1:]
    given = {}
    for a, b in zip(texts, out):
        given.setdefault(b.split()[1], set()).add(a.split()[1])
    assert all(len(v) == 1 for v in given.values())


def test_full_formats_grow(spark):
    drawn = [pii.surrogate("phone", "1234567", a, KEY) for a in (0, 31, 32, 64)]
    assert [len(x) for x in drawn] == [7, 7, 8, 9]
    assert pii.render("phone", "123-4567", drawn[2]) == drawn[2][:3] + "-" + drawn[2][3:]


def _gender(name):
    return next((g for (s, g), names in pii.GIVEN.items() if any(name.startswith(n) or name.casefold() == n.casefold() for n in names)), None)


def test_collisions_are_drawn_again(spark):
    names = [f"latin:x{i}" for i in range(400)]  # far more given names than the list holds
    df = spark.createDataFrame([("given_f", n) for n in names] + [("ssn", f"{i:09d}") for i in range(300)], "kind string, normal string")
    got = pii.surrogate_map(df, KEY).collect()
    assert len(got) == 700 and len({(r.kind, r.drawn) for r in got}) == 700
    assert not {(r.kind, r.drawn) for r in got} & {(r.kind, r.normal) for r in got}


def test_a_surrogate_is_never_an_entity_of_the_corpus(spark):
    first = pii.surrogate("given_m", "latin:john", 0, KEY)
    df = spark.createDataFrame([("given_m", "latin:john"), ("given_m", first)], "kind string, normal string")
    drawn = {r.normal: r.drawn for r in pii.surrogate_map(df, KEY).collect()}
    assert drawn["latin:john"] not in drawn and len(set(drawn.values())) == 2


def test_key_decides_and_repeats(spark):
    df = spark.createDataFrame([(1, "a1@b2.example.org")] * 3, "doc_id bigint, text string")
    one = [r.text for r in pii.pseudonymize(df, KEY).collect()]
    two = [r.text for r in pii.pseudonymize(df, b"other").collect()]
    assert len(set(one)) == 1 and len(one) == 3 and one[0] != two[0]
    assert pii.pseudonymize(spark.createDataFrame([], "doc_id bigint, text string"), KEY).count() == 0


def test_query_leaves_no_original(spark):
    from itemscope.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r for r in QUERIES["op2_pii_surrogates"](spark, sf).collect()}
    assert len(out) == len(docs)
    forms, drawn = {}, {}
    for i, text in docs.items():
        spans = pii.mentions(text)
        assert out[i].n_replaced == len(spans)
        if not spans:
            assert out[i].text == text
        after = pii.mentions(out[i].text)
        assert [m[0] for m in after] == [m[0] for m in spans]
        for a, b in zip(spans, after):
            assert forms.setdefault(a[:2], b[1]) == b[1] and drawn.setdefault(b[:2], a[1]) == a[1] and a[1] != b[1]
    assert len({k for k, _ in forms}) >= 3
    plain = re.compile(r"[\w.+-]+@\w+(?:\.\w+)+|\d+\.\d+\.\d+\.\d+|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{3}-\d{2}-\d{4}\b")
    hits = 0
    for i, text in docs.items():  # a scanner of its own: nothing that looks so stays where it was
        for m in plain.findall(text or ""):
            hits += 1
            assert m not in out[i].text
    assert hits > 50
