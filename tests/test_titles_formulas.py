"""Titles of acts and formulas on fixed vectors, nulls, empty and malformed inputs."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillon.functions import titles
from quillon.operators import formulas


def parsed(spark, title, language):
    rows = spark.createDataFrame([(title,)], "t string").select(titles.parse(F.col("t"), language).alias("p")).collect()
    return tuple(rows[0].p)


@pytest.mark.parametrize("language, title, want", [
    ("EN", "REGULATION (EU) No 575/2013 OF THE COUNCIL of 26 June 2013 on credit institutions and amending Regulation (EU) No 648/2012",
     (datetime.date(2013, 6, 26), "On credit institutions", "Regulation (EU) No 575/2013", ["32012R0648"], [])),
    ("EN", "Seventh Commission Directive 76/372/EEC of 1 March 1976 establishing methods of analysis", (datetime.date(1976, 3, 1), "Establishing methods of analysis", "Directive 76/372/EEC", [], [])),
    ("EN", "Directive (EU) 2015/2366 of 25 November 2015 on payments, amending Directives 2002/65/EC, 2009/110/EC and Regulation (EU) No 1093/2010, and repealing Directive 2007/64/EC",
     (datetime.date(2015, 11, 25), "On payments", "Directive (EU) 2015/2366", ["32002L0065", "32009L0110", "32010R1093"], ["32007L0064"])),
    ("EN", "Directive 2009/1/EC of 6 May 2009 repealing Framework Decision 2008/977/JHA and amending Annexes II and III to Council Directive 98/83/EC",
     (datetime.date(2009, 5, 6), None, "Directive 2009/1/EC", ["31998L0083"], ["32008F0977"])),
    ("EN", "Regulation (EC) No 1/2003 amending Regulations (EEC) Nos 1408/71 and 574/72", (None, "Regulation (EC) No 1/2003", "Regulation (EC) No 1/2003", ["31971R1408", "31972R0574"], [])),
    ("DE", "Beschluss 2008/977/JI des Rates vom 5. März 2008 über Daten sowie zur Aufhebung der Richtlinie 98/83/EG",
     (datetime.date(2008, 3, 5), "Über Daten sowie", "Beschluss 2008/977/JI", [], ["31998L0083"])),
    ("DE", "Verordnung (EU) Nr. 5/2013 vom 31. Februar 2013", (None, None, "Verordnung (EU) Nr. 5/2013", [], [])),
    ("ES", "REGLAMENTO POR EL QUE SE ESTABLECEN NORMAS Y SE MODIFICAN ACTOS", (None, "REGLAMENTO POR EL QUE SE ESTABLECEN NORMAS", None, [], [])),
    ("EN", "", (None, None, None, [], [])),
    ("EN", None, (None,) * 5),
])
def test_titles(spark, language, title, want):
    assert parsed(spark, title, language) == want


def test_languages_without_titles():
    with pytest.raises(ValueError, match="unsupported"):
        titles.parse(F.lit("Règlement"), "FR")


def test_marked_essence(spark):
    rows = [("A of 1 May 2000 on x, amending B", "On x"), ("A on x (Text with EEA relevance)", "On x (Text with EEA relevance)"), ("A", "B"), ("A", None), (None, "B")]
    got = spark.createDataFrame(rows, "t string, e string").select(titles.mark_essence(F.col("t"), F.col("e")).alias("m")).collect()
    p = '<p class="lxp-title_essence">'
    assert [r.m for r in got] == [f"A of 1 May 2000 {p}On x,</p> amending B", f"A {p}On x</p> (Text with EEA relevance)", "A", "A", None]
    again = spark.createDataFrame([(f"A of 1 May 2000 {p}on x</p>",)], "t string").select(titles.title_data(F.col("t"), F.lit("old"), F.lit("id"), "EN").alias("d")).first().d
    assert tuple(again) == (f"A of 1 May 2000 {p}On x</p>", "old", "On x")


def test_references_cleaned(spark):
    refs = F.array(*map(F.lit, ["PND_32012R0648", "ART_1", "DID_32001R0033", "ANX_I", "31998L0083", "PRE_1"]))
    assert spark.range(1).select(titles.clean_references(refs).alias("r")).first().r == ["32012R0648", "32001R0033", "31998L0083"]


@pytest.mark.parametrize("markup, want", [
    ('<FORMULA.S>12.5 × <EXPR><EXPR>1</EXPR><OVER/><EXPR><ROOT/><EXPR>1 – <HT TYPE="ITALIC">R</HT></EXPR></EXPR></EXPR></FORMULA.S>', r"12.5 \times {\frac{1}{\sqrt{{1 - \mathrm{R}}}}}"),
    ('<F>Σ<IND LOC="OVER">n</IND><IND LOC="UNDER">i</IND> c − Σ b</F>', r"\sum ^{n} _{i} c − \Sigma b"),
    ('<F><EXPR TYPE="BRACKET"><FRACTION><DIVIDEND>a</DIVIDEND><DIVISOR>b</DIVISOR></FRACTION></EXPR></F>', r"\left (\frac{a}{b}\right )"),
    ('<F>max <EXPR TYPE="BRACE">Density, ATE</EXPR></F>', r"\max \{Density, ATE\}"),
    ('<F>risk weight; ATE</F>', r"\text{risk weight} ; \mathrm{ATE}"),
    ("<F>a<OVER/>b</F>", r"\frac{a}{b}"), ("<F>φ ≤ 10 %</F>", r"\varphi \le 10 \%"), ('<F><OP.MATH TYPE="DIV"/><HT TYPE="X">q</HT></F>', "/ q"), ("<F/>", ""),
])
def test_formulas(markup, want):
    assert formulas.latex(markup)[0] == want


def test_formula_rows(spark):
    rows = [(1, "<FORMULA>a &lt; b</FORMULA>"), (2, None), (3, "  "), (4, "<FORMULA>"), (5, "<FORMULA>a<OVER/></FORMULA>"), (6, '<FORMULA TYPE="OUTLINE">a</FORMULA>'), (7, "<FORMULA><ROOT/></FORMULA>")]
    df = spark.createDataFrame(rows, "latex int, html string")  # names that clash with the result's
    got = {r.id: (r.latex, r.html, r.status) for r in formulas.render(df.withColumnRenamed("latex", "id"), "id", "html").collect()}
    assert got == {
        1: ("a < b", r'<span class="lxp-math">\(a &lt; b\)</span>', "ok"), 2: (None, None, "empty"), 3: (None, None, "empty"), 4: (None, None, "not_xml"), 5: (None, None, "malformed"),
        6: ("a", '<div class="lxp-math">$$a$$</div>', "ok"), 7: (None, None, "malformed"),
    }
    assert formulas.render(df.limit(0), "latex", "html").count() == 0
