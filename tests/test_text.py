"""Condition text: metals, pH, temperature, REMARK blocks, summaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sitegrade.functions import conditions as fc
from sitegrade.operators import conditions as cond

METALS = {
    "vapor diffusion in acetate buffer": "",
    "SODIUM CACODYLATE AT 293 K": "NA",
    "25 mM NiCl2 and calcium acetate": "CA NI",
    "PROTEIN 5 MG/ML, 0.1 M HEPES PH 7.5, TEMPERATURE 293K": "",
    "10MG/ML LYSOZYME, 50 MM NACL": "NA",
    "5 MG PROTEIN IN 0.2 M MG ACETATE": "MG",
    "2 mg/mL protein, 0.2 M Mg acetate": "MG",
    "10 mM MgCl2, 20 mM Mg2+": "MG",
    "CO-CRYSTALLIZED WITH LIGAND, PEG 3350": "",
    "Co-crystallization with inhibitor": "",
    "MICROSEEDING LEAD TO LARGER CRYSTALS": "",
    "10 mM CoCl2, 1 mM lead acetate": "CO PB",
    "0.2 M NaBr, 0.1 M Bis-Tris pH 6.5": "NA",
    "0.1 M KI, 0.1 M HEPES-NaOH pH 7.5": "K NA",
    "0.2 M CSCL, 0.1 M NAOH": "CS NA",
    "CaCl2NiCl2": "CA NI",
    "YB2SO4": "Y YB",
}
TEMPERATURES = {
    "TEMPERATURE 291K": "291", "TEMPERATURE 277.0 KELVIN": "277.0", "TEMPERATURE 293": "293",
    "TEMPERATURE 20 C": "293.15", "TEMPERATURE 4°C": "277.15", "TEMPERATURE 18.5 DEG C": "291.65",
    "TEMPERATURE 20": "", "TEMPERATURE 293 CRYSTALS GREW IN A WEEK": "293",
    "TEMPERATURE 20 DEGREES CELSIUS": "293.15",
}


def _one(spark, texts, column):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.t: r.v for r in df.select("t", column.alias("v")).collect()}


def test_metals(spark):
    got = _one(spark, METALS, F.array_join(fc.metals_in_text("t"), " "))
    assert got == METALS


def test_temperatures(spark):
    assert _one(spark, TEMPERATURES, fc.temperature_kelvin("t")) == TEMPERATURES


@pytest.mark.parametrize(
    "text, ph, span",
    [("PH 8.5 - 10% PEG 4000", "8.5", ""), ("pH 5.5-6.5", "", "5.5-6.5"), ("pH range: 4.0 – 4.5", "", "4.0-4.5"), ("p H = 7", "7", "")],
)
def test_ph(spark, text, ph, span):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(fc.ph_value("t").alias("a"), fc.ph_range("t").alias("b")).first()
    assert (row.a, row.b) == (ph, span)


def test_remark_block_and_numbering(spark):
    files = [
        ("1ABC", 0, "REMARK 280 SOLVENT CONTENT, VS (%): 45.00\nREMARK 280 CRYSTALLIZATION CONDITIONS: 10 MM NICL2,\nREMARK 280 PH 7.0\nEND"),
        ("1abc", 1, "REMARK 280 CRYSTALLIZATION CONDITIONS: NULL"),
        ("2def", 0, "REMARK 280 SOLVENT CONTENT, VS (%): 45.00"),
        ("1abc", 2, "REMARK 280 CRYSTALLIZATION CONDITIONS: 10 MM NICL2, PH 7.0"),
    ]
    df = spark.createDataFrame(files, "entry_id string, position int, text string")
    rows = cond.number_conditions(cond.from_remarks(df))
    got = {(r.condition_id, r.raw_details, r.pH) for r in rows.collect()}
    assert got == {
        ("1abc:condition:1", "10 MM NICL2, PH 7.0", "7.0"), ("1abc:condition:2", "10 MM NICL2, PH 7.0", "7.0"),
    }
    summary = cond.summarize_conditions(rows).first()
    assert summary.raw_text == "10 MM NICL2, PH 7.0" and summary.metals == ["NI"]
    assert summary.condition_ids == ["1abc:condition:1", "1abc:condition:2"]


def test_placeholders_are_no_condition(spark):
    rows = spark.createDataFrame(
        [("1abc", 0, "1", ".", "?", None, ".", None, None), ("1abc", 1, "2", "batch", None, None, None, None, "a")],
        "entry_id string, position int, crystal_id string, method string, pH string, pdbx_pH_range string, temp string, temp_details string, pdbx_details string",
    )
    got = cond.number_conditions(cond.from_category(rows)).collect()
    assert [(r.ordinal, r.method, r.raw_details) for r in got] == [(1, "batch", "a")]
