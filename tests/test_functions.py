import random
import re

import pytest
from pyspark.sql import functions as F

from onomast.functions import codes, numbers, replies, text

SAMPLES = [
    "", " ", "JOSE LUIS", " JOSE ", "JUAN CARLOS", "a\x1cb", "ARGÜELLO", "ÁNGEL", "María", "ß", "o'neil jean-luc",
    "línea\nuno\r\n\tdos", '**MARÍA** "y" _josé_ «x» 100%', "ﬁn ½ ²", "Ĳssel ǆ ŉ", "café‍", " x ", "snake_case *a*b*",
]


def words(seed, n=300):
    rng = random.Random(seed)
    letters = "abzAZáéíóúüñçÑÀßøłİı0 9_-.,*'\"\n\t \x1f́"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def test_counts(values):
    assert values(text.char_count, ["ANA", None, "ÁNGEL", ""]) == [3, 0, 6, 0]
    assert values(text.syllable_count, ["ARGÜELLO", None, "María", "yà", "AEIOU", "Ana Eva"]) == [3, 0, 2, 0, 1, 4]
    cases = SAMPLES + words(1)
    expected = [len(re.findall("[aeiouáéíóúü]+", c.lower())) for c in cases]
    assert values(text.syllable_count, cases) == expected


def test_is_compound_splits_like_python(values):
    cases = SAMPLES + words(2)
    assert values(text.is_compound, cases) == [len(c.split()) > 1 for c in cases]
    assert values(text.is_compound, [None]) == [False]


def test_normalize_label(values):
    cases = ["Álava", "Castellón/Castelló", "L’Alcúdia", "Straße", " ", "--", "Ávila", None]
    assert values(text.normalize_label, cases) == ["ALAVA", "CASTELLON CASTELLO", "L ALCUDIA", "STRASSE", None, None, "AVILA", None]


def test_normalized_labels_hold_only_letters_digits_and_single_blanks(values):
    cases = [f"a{chr(c)}b" for c in [*range(1, 0x250), *range(0x1E00, 0x1F00)]] + words(3)
    found = values(text.normalize_label, cases)
    assert all(label is None or re.fullmatch("[A-Z0-9]+( [A-Z0-9]+)*", label) for label in found)
    assert values(text.normalize_label, found) == found
    accented = ["àáâãäåāăą", "çćĉċč", "ñńņň", "ẁẃẅ", "ỳýÿ"]
    assert values(text.normalize_label, accented) == ["AAAAAAAAA", "CCCCC", "NNNN", "WWW", "YYY"]


def test_normalize_label_of_any_script(values):
    cases = ["ＦＵＬＬ", "ﬀ", "①", "Ŀ", "мир", "ﬁn ½"]
    assert values(lambda c: text.normalize_label(c, any_script=True), cases) == ["FULL", "FF", "1", "L", None, "FIN 1 2"]


def test_labels(values):
    cases = ["Balears,", "Palmas, Las", "Rioja", "a, b, c", " Rioja, ", "Coruña, A", "Rioja, La", "x,, y", None]
    expected = ["Balears", "Las Palmas", "La Rioja", "a, b, c", "La Rioja", "A Coruña", "La Rioja", "y x,", None]
    assert values(text.clean_label, cases) == expected
    assert values(lambda c: text.clean_label(c, {"ROMA": "LA CIUDAD"}), ["Roma", "Rioja"]) == ["La Ciudad", "Rioja"]
    labels = ["13 Ciudad Real", "02 Albacete", "7", "", None]
    assert values(text.label_code, labels) == [13, 2, 7, None, None]
    assert values(text.label_text, labels) == ["Ciudad", "Albacete", None, None, None]
    assert values(lambda c: text.label_text(c, "full"), labels) == ["Ciudad Real", "Albacete", None, None, None]
    with pytest.raises(ValueError):
        text.label_text(F.col("x"), "half")


def test_title_case_is_python_title(values):
    cases = SAMPLES + ["O'NEIL", "jean-luc", "ßa", "maría josé"]
    assert values(text.title_case, cases) == [c.title() for c in cases]


def test_keys(values):
    assert values(text.build_key, [(" maria luisa ", "Female"), ("José", "Male")], "string,string") == ["MARIA_LUISA-f", "JOSÉ-m"]
    cases = [("María José", "Female"), ("--ana--", None), ("ANA", ""), ("O'Neil", "Male")]
    assert values(text.safe_identifier, cases, "string,string") == ["MAR_A_JOS_f", "ANA_x", "ANA_x", "O_NEIL_m"]


def test_clean_text(values):
    given = ('**MARÍA** y josé son *nombres* __raros__ «x»\n"hola" 100%', "maría josé")
    assert values(text.clean_text, [given], "string,string") == ["María y José son nombres raros x 'hola' 100"]
    terms = ["maría", "a.b", r"x\1 $2", "-z", "", "é", "O'Neil ana", " b", "\\E x"]
    cases = [(t, terms[i % len(terms)]) for i, t in enumerate(SAMPLES + words(5) + ["a.b A.B aXb x\\1 $2 z-z -z é É éé o'neil ANA"] * len(terms))]
    for found in values(text.clean_text, cases, "string,string"):
        assert '"' not in found and not re.search("[\\n\\t«»%*]", found)
    literal = [("a.b A.B aXb", "a.b"), ("o'neil y ANA", "O'Neil ana"), ("é É éé", "é"), ("x-y (z): ¿qué?", "q")]
    assert values(text.clean_text, literal, "string,string") == ["A.B A.B aXb", "O'Neil y Ana", "É É éé", "x-y (z): qué?"]
    assert values(text.clean_text, [("x *y*", None)], "string,string") == ["x y"]


def test_truncate_and_default(values):
    cases = ["x" * 500, "y" * 501, None, ""]
    assert values(text.truncate_ellipsis, cases) == ["x" * 500, "y" * 497 + "...", None, ""]
    assert values(lambda c: text.default_if_falsy(c, F.lit("d")), ["", None, "a"]) == ["d", "d", "a"]


def test_numbers(values):
    assert values(numbers.decimal_comma, ["9,534", "40.819", " 1 ", "1e2", "x", "1.2,3", "9.5d", "nan", None]) == [
        9.534, 40.819, 1.0, 100.0, None, None, None, None, None,
    ]
    assert values(numbers.whole_number, ["2", " 3", "-4", "3.7", "x", "1_0", None]) == [2, 3, -4, None, None, None, None]
    assert values(numbers.strip_digits_sep, ["48.000.000", "1 234", "", ". ", None]) == [48000000, 1234, None, None, None]
    halves = [0.5, 1.5, 2.5, -0.5, -1.5, 35973.5, 0.49999999999999994]
    assert values(numbers.round_count, halves, "double") == [round(h) for h in halves]
    rates = [(166667, 9.534, "‰"), (200, 12.5, "%"), (200, 2.5, None), (200, 3.5, "x"), (None, 9.5, "‰")]
    assert values(numbers.rate_to_count, rates, "bigint,double,string") == [1589, 25, 2, 4, None]
    assert values(numbers.share_percent, [(1, 4), (1, 0), (None, 4)], "bigint,bigint") == [25.0, None, None]


def test_codes(values):
    assert values(codes.gender_alias, ["Male", "FEMALE", "other"]) == [["Hombres", "Total"], ["Mujeres", "Total"], ["Total"]]
    assert values(codes.gender_code, ["Male", "Female"]) == ["1", "6"]
    for wrong in ("male", None):
        with pytest.raises(Exception, match="no code for the gender"):
            values(codes.gender_code, [wrong])


def test_json_default(values):
    cases = ['{"origin":"Vasco"}', None, "no", "```json\n{}\n```", "[]", "{}", '{"origin":', "{'origin':'X'}", '{"Origin":"X"}',
             '{"origin":"X","origin":"Y"}', '{"origin":null}', "", '[{"origin":"X"}]', '{"origin":""}']
    expected = ["Vasco"] + ["Otro"] * 8 + ["Y", "Otro", "Otro", "Otro", ""]
    assert values(lambda c: replies.json_default(c, "origin", "Otro"), cases) == expected


def test_json_all_or_nothing(values):
    failed = {"a": "A", "b": "B"}

    def read(c):
        return replies.json_all_or_nothing(c, "b", failed, {"a": "A", "b": ""})

    assert {tuple(r) for r in values(read, ['{"a":"x","b":5}', '{"a":"x","b":[1]}', '{"a":"x","b":{"c":"d"}}'])} == {("A", "B", False)}
    cases = ['{"a":"x","b":"y"}', "{}", '{"a":"x"}', '{"a":"x","b":null}', '{"a":null,"b":"y"}', "[]", None, '{"a"', "x"]
    assert [tuple(r) for r in values(read, cases)] == [
        ("x", "y", True), ("A", "", True), ("x", "", True), ("A", "B", False), ("A", "y", True),
        ("A", "B", False), ("A", "B", False), ("A", "B", False), ("A", "B", False),
    ]
