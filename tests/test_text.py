import math

from assayframe.functions import keys, text


def test_numbers(values):
    cases = {
        "123.45": 123.45,
        " 1 ": 1.0,
        "NA": None,
        "n/a": None,
        "null": None,
        "": None,
        "-": None,
        ".": None,
        "1,234.56": 1234.56,
        "1 234": 1234.0,
        "1e3": 1000.0,
        "1_000": 1000.0,
        "1__0": None,
        "_1": None,
        "1.": 1.0,
        ".5": 0.5,
        "+.5E-1": 0.05,
        "not_a_number": None,
        "1.0d": None,
        "1f": None,
        "0x1p3": None,
        "<5": None,
        " 7 ": 7.0,
        "inf": math.inf,
        "-Infinity": -math.inf,
        "1e400": math.inf,
    }
    assert values(text.parse_number, list(cases)) == list(cases.values())
    assert all(math.isnan(v) for v in values(text.parse_number, ["nan", "NaN", "-nan", "+NAN"]))


def test_numbers_agree_with_python(values):
    def expected(raw):
        s = raw.strip()
        if s.upper() in ("", "NA", "N/A", "NULL", "-", "."):
            return None
        for candidate in (s, s.replace(",", "").replace(" ", "")):
            try:
                return float(candidate)
            except ValueError:
                pass
        return None

    parts = ["", "1", "12", "1_2", "_", ".", "e", "E5", "-", "+", ",", " ", "inf", "d"]
    cells = [a + b + c for a in parts for b in parts for c in parts]
    assert values(text.parse_number, cells) == [expected(c) for c in cells]
    unreadable = values(text.is_unreadable_number, cells)
    missing = ("", "NA", "N/A", "NULL", "-", ".")
    assert unreadable == [
        expected(c) is None and c.strip().upper() not in missing for c in cells
    ]


def test_strip_takes_all_unicode_spaces(values):
    cells = ["\x1c a b\x85", "　x ", "\t\n", "a b", None]
    assert values(text.strip, cells) == ["a b", "x", "", "a b", None]


def test_lines(values):
    assert values(text.split_lines, ["a\r\nb\rc\n\nd\n"]) == [["a", "b", "c", "", "d", ""]]


def test_bad_utf8_is_dropped(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9"),)], "raw binary")
    assert df.select(text.drop_bad_utf8(F.col("raw"))).first()[0] == "abé"
    kept = spark.createDataFrame([(bytearray("a\ufffdb".encode()),)], "raw binary")
    assert kept.select(text.drop_bad_utf8(F.col("raw"))).first()[0] == "a\ufffdb"


def test_factors(values):
    cases = {
        "Group:Control": {"Group": "Control"},
        "Group:Control | Age:45 | Sex:M": {"Group": "Control", "Age": "45", "Sex": "M"},
        "": {},
        "-": {},
        "loose | a:1 || b:x:y": {"a": "1", "b": "x:y"},
        "a:1|b:2|a:3|:4|c:": {"b": "2", "a": "3", "c": ""},
        None: {},
    }
    assert values(text.factor_map, list(cases)) == list(cases.values())
    assert values(text.factors_without_colon, ["loose | a:1 | more"]) == [["loose", "more"]]
    lower = values(lambda c: text.factor_map(c, lower_keys=True, keep_empty_keys=True), ["A:1|a:2|:x"])
    assert lower == [{"a": "2", "": "x"}]


def test_labels_and_names(values):
    labels = ["Sample 123", "6018 post B S_87", "Sample___123___Test", " #a/b# "]
    assert values(keys.normalize_sample_label, labels) == [
        "Sample_123",
        "6018_post_B_S_87",
        "Sample_123_Test",
        "a_b",
    ]
    names = ["  Glucose  ", "  L-Lactic   Acid  ", "β-Alanine", "a \tb"]
    assert values(keys.normalize_feature_name, names) == [
        "glucose",
        "l-lactic acid",
        "β-alanine",
        "a b",
    ]


def test_keys(values):
    import hashlib

    assert values(keys.sample_uid, [("ST000315", "6018 post B S_87")]) == ["ST000315:6018 post B S_87"]
    assert values(keys.feature_uid, [("AN000501", "L-Lactic Acid")]) == ["AN000501:met:l-lactic acid"]
    long = "x y" * 40
    hashed = hashlib.md5(f"{long}|R".encode()).hexdigest()[:16]
    bare = hashlib.md5(f"{long}|".encode()).hexdigest()[:16]
    cases = [("A", "β-Ala*nine (D)", None), ("A", long, "R"), ("A", long, None), ("A", "__", None)]
    assert values(keys.ms_feature_uid, cases) == [
        "A:met:-ala_nine (d)",
        f"A:met:{hashed}",
        f"A:met:{bare}",
        "A:met:",
    ]
    sha = hashlib.sha1(b"S 1").hexdigest()[:12]
    assert values(keys.nmr_sample_uid, [("ST", "AN", "S 1")]) == [f"ST:AN:s:{sha}"]
    assert values(keys.nmr_feature_uid, [("AN", "S 1")]) == [f"AN:nmrbin:{sha}"]
    assert values(keys.known_or_unknown, [None, "", "x"]) == ["UNKNOWN", "UNKNOWN", "x"]


def test_strip_takes_texts_with_clean_ends_as_they_are(values):
    cells = ["a b", "!~", " a", "a ", "\x7fa", "\u00e9", "a\u2003", "\x1fa", "\u00e9 ", "~", "", None]
    assert values(text.strip, cells) == ["a b", "!~", "a", "a", "\x7fa", "\u00e9", "a", "a", "\u00e9", "~", "", None]
