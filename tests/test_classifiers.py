"""Every rule of the vocabularies: a hit, a near miss, a boundary; and the order of the rules."""

import itertools

import pytest
from pyspark.sql import functions as F

from assayframe.functions import devices, filetypes, tags


def of_path(fn):
    return lambda path, name: fn(tags.path_text(path, name))


# what stands around a word: (before, behind, whether the word still counts as one)
EDGES = [("", "", True), ("x/", ".raw", True), ("7-", " 3", True), ("q", "", False), ("", "z", False)]
EDGES += [("_", "", False), ("", "_b", False)]


def placed(words, label):
    """Each word in each surrounding, with the label that is due."""
    for word, (before, behind, counts) in itertools.product(words, EDGES):
        yield f"{before}{word}{behind}", label if counts else None


@pytest.mark.parametrize(
    ("label", "words"),
    [
        ("Serum", ["serum", "PLASMA", "Blood"]),
        ("Urine", ["Urine", "URINARY"]),
        ("Feces", ["feces", "Faeces", "STOOL", "Fecal", "faecal"]),
        ("CSF", ["CSF", "Cerebrospinal"]),
    ],
)
def test_sample_type_words(values, label, words):
    cases = list(placed(words, label))
    found = values(of_path(tags.sample_type_tag), [(text, None) for text, _ in cases])
    assert found == [due for _, due in cases]


def test_sample_type_order_and_unknown_words(values):
    cases = {
        ("csf-stool-urinary-plasma", None): "Serum",
        ("csf-stool", "urine.d"): "Urine",
        ("csf", "fecal 2"): "Feces",
        ("saliva", "muscle"): None,
        (None, None): None,
    }
    assert values(of_path(tags.sample_type_tag), list(cases)) == list(cases.values())


def test_exposure_words(values):
    ob = ["ob", "Obese", "OBESITY", "overweight", "Case", "high BMI", "highbmi", "High-BMI"]
    con = ["con", "Control", "LEAN", "normal", "Healthy", "reference", "low BMI", "lowbmi"]
    cases = [*placed(ob, "OB"), *placed(con, "CON")]
    found = values(of_path(tags.exposure_tag), [(text, None) for text, _ in cases])
    assert found == [due for _, due in cases]


def test_exposure_of_bmi_numbers_and_both_sides(values):
    cases = {
        ("run BMI>29", "a"): ("OB", False),
        ("run bmi_31", "a"): ("OB", False),
        ("run bmi-27", "a"): (None, False),  # only > and 3 begin the number
        ("run bmi>", "a"): (None, False),
        ("lean arm", "case 4"): (None, True),
        ("week2/reference", "overweight.d"): (None, True),
        ("observe", "contour"): (None, False),
    }
    assert values(of_path(tags.exposure_tag), list(cases)) == [e for e, _ in cases.values()]
    warned = values(of_path(tags.exposure_warning), list(cases))
    assert [w == tags.EXPOSURE_CONFLICT for w in warned] == [w for _, w in cases.values()]


def test_device_by_type_and_path(values):
    neutral, gc, nmr, lc = "w/12.d", "w/gcms 3.d", "w/1h-nmr.d", "w/uhplc.d"
    cases = {}
    for kind in tags.NMR_TYPES:  # the type alone decides
        cases |= {(p, kind): "NMR" for p in (neutral, gc, nmr, lc)}
    for kind in tags.MS_TYPES:  # gas unless the path says nothing of it
        cases |= {(gc, kind): "GCMS", (neutral, kind): "LCMS", (nmr, kind): "LCMS", (lc, kind): "LCMS"}
    for kind in ("results_txt", None):  # the path alone decides, in the order NMR, gas, liquid
        cases |= {(neutral, kind): None, (gc, kind): "GCMS", (nmr, kind): "NMR", (lc, kind): "LCMS"}
        cases |= {(f"{gc} {nmr}", kind): "NMR", (f"{lc} {gc}", kind): "GCMS"}
    tag = lambda path, kind: tags.device_tag(tags.path_text(path, F.lit(None)), kind)
    assert values(tag, list(cases)) == list(cases.values())


def test_device_path_spellings(values):
    gas = ["gc-ms", "GC_MS", "gc ms", "gcms", "GC-TOF", "gc_tof", "gc ei", "gcei", "w/GC/3", "- _gc_x"]
    gas_not = ["gc", "gc--ms", "gctof", "agcms", "gc.ms", "w/GC"]
    lc = ["LC_MS", "lc ms", "lcms", "hplc", "Uplc", "uhplc"]
    lc_not = ["lc", "lc--ms", "uhplcs", "xhplc"]
    nmr = ["nmr", "1hnmr", "1H_NMR", "13c-nmr", "v/NMR/2"]
    nmr_not = ["nmrx", "2hnmr"]
    cases = {p: "GCMS" for p in gas} | {p: "LCMS" for p in lc} | {p: "NMR" for p in nmr}
    cases |= {p: None for p in gas_not + lc_not + nmr_not}
    tag = lambda path: tags.device_tag(F.lower(path), F.lit(None))
    assert values(tag, list(cases)) == list(cases.values())


def test_every_platform_rule(values):
    hits = {
        "esi positive": "ESI_pos",
        "esipos": "ESI_pos",
        "ESI-negative": "ESI_neg",
        "esi_neg": "ESI_neg",
        "positivemode": "ESI_pos",
        "negative-mode": "ESI_neg",
        "3+esi": "ESI_pos",
        "3-esi": "ESI_neg",
        "apci pos": "APCI_pos",
        "APCIneg": "APCI_neg",
        "hilic": "HILIC",
        "rp": "RP",
        "c18": "C18",
        "c8": "C8",
        "qqq": "QQQ",
        "triple-quad": "QQQ",
        "qtof": "QTOF",
        "q_tof": "QTOF",
        "orbitrap": "Orbitrap",
        "tripletof": "TripleTOF",
        "tof": "TOF",
        "uplc": "UPLC",
        "uhplc": "UHPLC",
        "hplc": "HPLC",
    }
    misses = ["esi", "esi possible", "+esi", "apci positive", "c180", "c 8", "quad", "tofs", "rpx", "qq"]
    cases = hits | dict.fromkeys(misses)
    assert values(lambda t: tags.platform_tag(F.lower(t)), list(cases)) == list(cases.values())


def test_platform_order_and_limit(values):
    cases = {
        # the first rule that gives a name decides its place, not the text
        "ESI neg, positive mode": "ESI_neg_ESI_pos",
        "negative mode, ESI pos": "ESI_pos_ESI_neg",
        "hplc orbitrap c18": "C18_Orbitrap_HPLC",
        "hplc tof qqq rp hilic": "HILIC_RP_QQQ",
        "triple quad qqq": "QQQ",
        "q-tof": "QTOF_TOF",  # the hyphen is a boundary before tof
    }
    assert values(lambda t: tags.platform_tag(F.lower(t)), list(cases)) == list(cases.values())


def test_all_tags_together(values):
    a, b, c = values(
        tags.all_tags,
        [
            ("batch 9/urinary/low BMI", "rp qqq.txt", "metabo_table_html"),
            ("overweight", "control 3", "mwtab_ms"),
            (None, None, None),
        ],
    )
    assert tuple(a) == ("LCMS", "Urine", "CON", "RP_QQQ", [])
    assert (b.device, b.exposure, b.warnings) == ("LCMS", None, [tags.EXPOSURE_CONFLICT])
    assert tuple(c) == (None, None, None, None, [])


# ---------------------------------------------------------------- derivation


def test_device_words_of_texts(values):
    hits = {
        "NMR": ["Bruker nmr 600", "nuclear\tmagnetic field"],
        "GCMS": ["a gc-ms run", "gc_ms", "gcms", "Gas  Chromatography", "gc/ms", "gc mass  spec", "gc tof"],
        "LCMS": ["a lc ms run", "lc-ms", "lcms", "liquid chromatograph", "hplcx", "UPLC 2", "lc/msms", "lctof"],
        "MS": ["ms", "items", "Mass Spec lab"],
        None: ["", "gas", "chromatography", "lc", "gc", "nmrx", "mass of a spectrum"],
    }
    cases = {text: label for label, texts in hits.items() for text in texts}
    cases |= {"lcms then gcms": "GCMS", "gcms then nmr": "NMR"}
    assert values(devices.device_of_text, list(cases)) == list(cases.values())


def test_exposure_and_matrix_words_of_texts(values):
    exposure = {w.title(): "OB" for w in devices.TEXT_OB} | {w.upper(): "CON" for w in devices.TEXT_CON}
    # words count inside others, and the first list wins
    exposure |= {"jobs": "OB", "second": "CON", "cleaning": "CON", "lean but obese": "OB"}
    exposure |= {"arm 2": None, "o b": None, "": None, None: None}
    assert values(devices.exposure_of_text, list(exposure)) == list(exposure.values())
    matrix = {f"1 {w.upper()}s": label for label, words in devices.TEXT_MATRIX for w in words}
    matrix |= {"liver, urine": "Urine", "hair": None, "faecal": None, "": None, None: None}
    assert values(devices.matrix_of_text, list(matrix)) == list(matrix.values())


def test_scores_of_every_exposure_word(values):
    def scores(key, value):
        ob, con = devices.exposure_scores(devices.plain_factor(F.lower(key), value))
        return F.concat_ws("/", ob, con)

    cases = {}
    for word in ("ob", "case", "overweight", "bmi>"):
        cases |= {("arm group", word.upper()): "10/0", ("class", f"{word} 3"): "5/0"}
    # "ob" stands before them in the list and is part of them, so they never are the whole value
    cases |= {("status", "Obese"): "5/0", ("status", "obesity"): "5/0"}
    for word in ("lean", "normal", "healthy", "reference"):
        cases |= {("diagnosis", word): "0/10", ("my-cohort", f"{word}er"): "0/5"}
    cases |= {("bmi", "CON"): "0/10", ("bmi", "control"): "0/5"}
    for word in devices.EXCLUDED_VALUES:
        cases[("group", f"{word} normal")] = "0/0"
        cases[("group", f"{word} lean")] = "0/5"
    cases |= {
        ("Condition", "lean or obese"): "5/5",
        ("PHENO TYPE", "normal"): "0/10",
        ("site", "obese"): "0/0",
        ("group", "arm 7"): "0/0",
        ("group", devices.STUDY_NAMES[0].title()): "0/0",
    }
    assert values(scores, list(cases)) == list(cases.values())


def test_higher_score_wins(values):
    pick = lambda ob, con: devices.exposure_of_scores(ob.cast("int"), con.cast("int"))
    cases = {("10", "5"): "OB", ("0", "5"): "CON", ("5", "5"): None, ("0", "0"): None}
    assert values(pick, list(cases)) == list(cases.values())


def test_device_of_content_is_looked_for_in_the_whole_text(values):
    far = "- \n" * 60_000
    cases = {
        "seen by 13C NMR here": "NMR",
        "Gas\n chromatograph": "GCMS",
        "with uplc": "LCMS",
        "x MS_METABOLITE_DATA x": "MS",
        far + "nuclear magnetic resonance": "NMR",
        "nmrs": None,
        None: None,
    }
    assert values(devices.device_from_content, list(cases)) == list(cases.values())
    short = lambda text: devices.device_from_content(text, 100)
    assert values(short, [far + "nmr", "a nmr"]) == [None, "NMR"]


def test_file_types(values):
    marker = "#Metabolomics WORKBENCH study"
    cases = {
        ("q.txt", f"first\n{marker}"): "mwtab",
        ("q.Txt", "\n" * 5_000 + marker): "mwtab",
        ("q.csv", marker): "unknown",
        ("q_RES.txt", marker): "results_txt",
        ("q_res.txt.bak", marker): "results_txt",
        ("my NORMALIZED binned data 2.xlsm", None): "nmr_binned_xlsx",
        ("normalized binned data.csv", None): "unknown",
        ("q.htm", "-" * 70_000 + "Metabolite_NAME"): "metabo_table_html",
        ("q.html", "metabolite name"): "unknown",
        ("q.txt", None): "unknown",
        ("q", marker): "unknown",
    }
    assert values(filetypes.detected_type, list(cases)) == list(cases.values())


def test_a_caller_may_shorten_the_scan(values):
    marker = "#metabolomics workbench"
    texts = [("q.txt", f"1\n2\n{marker}"), ("q.txt", f"1\r\n{marker}"), ("q.htm", "123456 metabolite_name")]
    first = lambda name, text: filetypes.detected_type(name, text, 2, 9)
    assert values(first, texts) == ["unknown", "mwtab", "unknown"]
    two = lambda text: filetypes.has_mwtab_marker(text, 2)
    assert values(two, [t for _, t in texts]) == [False, True, False]
    assert values(filetypes.has_mwtab_marker, [t for _, t in texts]) == [True, True, False]


def test_extensions(values):
    suffixes = {"n.Tsv": ".tsv", "n.v2.HTM": ".htm", ".csv": "", "n": "", "n.": "", "..tsv": ""}
    assert values(filetypes.extension_of, list(suffixes)) == list(suffixes.values())
    given = {e.upper(): True for e in filetypes.EXTENSIONS} | {".json": False, ".gz": False, "": False}
    assert values(filetypes.is_allowed_extension, list(given)) == list(given.values())
    assert filetypes.normalize_extensions(["PDF", ".Zip", "pdf"]) == [".pdf", ".zip"]
