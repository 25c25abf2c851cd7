"""Registry, triples, identifiers, text and sequences on fixed vectors, and every registered SQL against DuckDB."""

import datetime
import io
import zipfile

import duckdb
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions import ids, text
from quillon.operators import documents, lookups, metadata, registry, sequences
from quillon.plans import reference
from quillon.sources import readers, writers
from quillon.streaming import incremental

SF = "/root/testdata/sf0.001"


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize("text_, base, kind, rest", [
    ("32013R0575", "32013R0575", "act", None), ("02013R0575-20170315", "32013R0575", "consolidated", datetime.date(2017, 3, 15)), ("32013R0575R(01)", "32013R0575", "corrigendum", 1),
    ("31972A0722(05)", "31972A0722(05)", "act", None), ("31972A0722(05)R(01)", "31972A0722(05)", "corrigendum", 1), ("12012A/TXT", None, None, None), ("32013R575", None, None, None), ("", None, None, None),
])
def test_identifiers(spark, text_, base, kind, rest):
    c = ids.celex_compound(F.lit(text_))
    got = one(spark, c)
    if base is None:
        assert got is None
        return
    assert (got.base, got.kind) == (base, kind) and rest in (None, got.version, got.corrigendum)
    assert one(spark, ids.render_compound(c["base"], c["version"], c["corrigendum"])) == text_


def test_months(spark):
    m = one(spark, ids.month_bounds(F.lit("2020-02-11").cast("date")))
    assert m.ultimo.day == 29 and m.previous == datetime.date(2020, 1, 1) and m.next == datetime.date(2020, 3, 1)
    assert one(spark, ids.version_date(F.lit("initial"))) == datetime.date(1900, 1, 1) and one(spark, ids.version_date(F.lit("x"))) is None


def test_text(spark):
    assert one(spark, text.quotations(text.standard_quotes(F.lit(' "a b" or “c”.')))) == ["a b", "c"]
    assert one(spark, text.standard_label(F.lit("a) x"))) == "(a) x" and one(spark, text.strip_tags(F.lit("<p>a <b>c</b></p> "))) == "a c"
    assert one(spark, text.negligible(F.lit("  "))) is True and one(spark, text.label_candidates(F.lit("(i) x"), "en")) == ["alpha", "roman"]
    assert one(spark, text.label_candidates(F.lit("(i) x"), "fr")) is None


@pytest.mark.parametrize("text_, want", [
    ("Chapter 5", ("CHP_5", "Chapter 5", None)), ("ANNEX", ("ANX", "ANNEX", None)), ("ANNEX II B", ("ANX_II_B", "ANNEX II B", None)), ("ANNEX Correlation Tables", ("ANX", "ANNEX", "Correlation Tables")),
    ("Subsection IIa", ("SUB_IIa", "Subsection IIa", None)), ("Article 10.", None), ("", None), ("Yeah, Whatever", None), ("(Article 7)", None),
])
def test_headings(text_, want):
    assert sequences.heading(text_, "en") == want


def test_labels():
    letters = [f"({c})" for c in "abcdefghi"]
    assert sequences.resolve_labels([*letters, "(i)", "(ii)", "(iii)", "(j)"], "en") == ["alpha"] * 9 + ["roman"] * 3 + ["alpha"]
    assert sequences.resolve_labels([], "en") == [] and sequences.resolve_labels(["none"], "en") == [None]
    with pytest.raises(ValueError):
        sequences.resolve_labels(["(a)"], "fr")


@pytest.mark.parametrize("kinds", [
    [("alpha", "abcdefghijklmn")], [("numbr", range(1, 12))], [("alpha", "abc"), ("roman", ["i", "ii", "iii", "iv", "v", "vi"]), ("alpha", "d")],
    [("alpha", "abcdefgh"), ("roman", ["i", "ii", "iii"])], [("alpha", "abcdefghi"), ("roman", ["i", "ii", "iii"]), ("alpha", "jkl"), ("roman", ["i", "ii"]), ("alpha", "m")],
])
def test_label_sequences(kinds):
    flat = [(kind, str(v)) for kind, values in kinds for v in values]
    assert sequences.resolve_labels([f"({v})" for _, v in flat], "en") == [kind for kind, _ in flat]


def plain_toc(ordinates):
    """Parents by walking back: what is open is what no later heading has closed."""
    several, path, out = sum(o.startswith("ANX") for o in ordinates) > 1, [], {}
    for k, o in enumerate(ordinates):
        axis = o.split("_")[0]
        leaf = axis in sequences.LEAVES
        in_annex = any(a == "ANX" for a, _, _ in path)
        if axis == "ANX":
            path = [("CNT", len(ordinates), False)] * several
        else:
            low = several if in_annex and not leaf else 0
            same = [d for d, (a, _, _) in enumerate(path) if a == axis and d >= low]
            path = path[: same[0]] if same else path[:-1] if path and path[-1][2] and not (in_annex and not leaf) else path
        out[k] = path[-1][1] if path else -1
        path = [*path, (axis, k, leaf)]
    return out


def test_toc(spark):
    def nest(ordinates):
        df = spark.createDataFrame([(1, i, o) for i, o in enumerate(ordinates)], "doc_id int, pos int, ordinate string")
        return {r["pos"]: r for r in sequences.toc(df).collect()}

    rows = nest("CHP_I SEC_1 ART_1 SEC_2 ART_2 CHP_II ART_3 ANX_I ANX_II".split())
    assert rows[1]["id"] == "toc-CHP_I-SEC_1" and rows[4]["parent"] == 3 and rows[5]["parent"] == -1 and rows[9]["id"] == "toc-ANX" and rows[8]["parent"] == 9
    single = nest(["ART_1", "ART_2", "ANX"])
    assert single[1]["parent"] == -1 and single[2]["parent"] == -1 and single[2]["id"] == "ANX" and nest([]) == {}
    flat = nest("CHP_I ART_1 CHP_II ART_2 CHP_III SEC_1 ART_3 SEC_2 ART_4 ANX_I CHP_1 SEC_1 ANX_II CHP_1".split())
    assert flat[6]["id"] == "ART_3" and flat[5]["id"] == "toc-CHP_III-SEC_1" and flat[10]["type"] == "sub-container" and flat[11]["id"] == "ANX_I-CHP_1-SEC_1" and flat[13]["parent"] == 12
    rng, lists = random.Random(3), []
    for d in range(60):
        body = [rng.choice(["CHP_I", "SEC_1", "ART_1", "TIT_I", "SUB_1"]) for _ in range(rng.randint(1, 14))]
        lists.append(body + [x for a in range(rng.choice([0, 1, 3])) for x in (f"ANX_{a}", *rng.choices(["CHP_1", "SEC_1"], k=rng.randint(0, 3)))])
    df = spark.createDataFrame([(d, i, o) for d, os in enumerate(lists) for i, o in enumerate(os)], "doc_id int, pos int, ordinate string")
    got = {}
    for r in sequences.toc(df).collect():
        if r["pos"] < len(lists[r["doc_id"]]):
            got.setdefault(r["doc_id"], {})[r["pos"]] = r["parent"]
    assert got == {d: plain_toc(os) for d, os in enumerate(lists)}


def test_nodes():
    nodes = documents.parse('<div id="a">x<p>1<br>2<p>3</p>t</div>')
    assert [(n["tag"], n["parent_id"], n["text"], n["tail"]) for n in nodes] == [("div", -1, "x", None), ("p", 0, "1", None), ("br", 1, None, "2"), ("p", 0, "3", "t")]
    assert documents.parse(None) == []


def test_rdfa_round_trip(spark):
    acts = spark.createDataFrame([("1", "/eu/1/", datetime.date(2020, 1, 2), ["b", "a"]), ("2", None, None, [])], "id string, source string, day date, is_about array<string>")
    metas = metadata.rdfa(acts, "id", "eli", ["source", "day", "is_about"])
    back = {r.id: r for r in metadata.from_rdfa(metas, "id", ["source", "day"], ["is_about"], "eli").collect()}
    assert back["1"].source == "/eu/1/" and back["1"].day == "2020-01-02" and back["1"].is_about == ["a", "b"] and "2" not in back
    assert {r.datatype for r in metas.where("property = 'eli:day'").collect()} == {"xsd:date"}


def test_sources(spark, tmp_path):
    (tmp_path / "t.nt").write_text('<http://www.w3.org/2002/07/owl#a> <http://data.europa.eu/eli/ontology#title> "A \\"b\\""@en .\n# no\n<x:1> <x:2> <x:3> .\n')
    got = readers.n_triples(spark, str(tmp_path / "t.nt")).collect()
    assert [(r.s, r.p, r.o, r.o_kind, r.lang) for r in got] == [("owl:a", "eli:title", 'A "b"', "literal", "en"), ("x:1", "x:2", "x:3", "iri", None)]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.xml", "<a/>")
        z.writestr("b.tif", "x")
    files = spark.createDataFrame([("p", bytearray(data.getvalue())), ("q", bytearray(b"no"))], "path string, content binary")
    rows = {r.path: r for r in readers.zipped_bodies(files).collect()}
    assert rows["p"].name == "a.xml" and bytes(rows["p"].body) == b"<a/>" and rows["q"].error
    xml = "<r><result><ID_CELEX>32013R0575</ID_CELEX><IN_FORCE>true</IN_FORCE><LANG>EN</LANG></result><result><ID_CELEX>bad</ID_CELEX></result></r>"
    assert readers.search_hits(xml) == [{"celex": "32013R0575", "in_force": True, "date": None, "languages": ["EN"]}]
    now = [0.0]
    limit = readers.RateLimiter(str(tmp_path / "lock"), 2.0, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(4):
        limit.wait()
    assert now[0] == 6.0
    writers.write_documents(spark.createDataFrame([("32013R0575", "EN", "x")], "celex string, language string, body string"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).where("year = 2013 AND language = 'EN'").count() == 1


def test_incremental(spark, tmp_path):
    schema, inbox = "celex string, ord long, in_force boolean, publication_date date, language string", tmp_path / "in"
    inbox.mkdir()
    run = lambda: incremental.refresh(spark, str(inbox), schema, str(tmp_path / "reg"), str(tmp_path / "ck")).awaitTermination()
    (inbox / "a.json").write_text('{"celex": "A", "ord": 1, "in_force": true, "language": "EN"}\n')
    run()
    (inbox / "b.json").write_text('{"celex": "A", "ord": 1, "publication_date": "2020-01-01", "language": "EN"}\n{"celex": "B", "ord": 2, "in_force": false, "language": "DE"}\n')
    run()
    got = {r.celex: r for r in spark.read.parquet(str(tmp_path / "reg" / "1")).collect()}
    assert got["A"].in_force is True and got["A"].publication_date == datetime.date(2020, 1, 1) and got["B"].in_force is False


def test_three_valued_versions(spark):
    rows = spark.createDataFrame([("a", datetime.date(2020, 1, 1), "EN", None, None), ("a", datetime.date(2021, 1, 1), "EN", "repealer", "u"), ("b", datetime.date(2020, 1, 1), "EN", "failed", "")], "celex string, date date, language string, transformation string, url_html string")
    assert [(r.celex, r.latest.year) for r in registry.latest_version(rows).collect()] == [("a", 2020)]
    assert {r.celex: r.latest for r in registry.latest_available(rows).collect()} == {"a": None, "b": None}


@pytest.mark.parametrize("name", sorted(reference.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "orders", "lineitem", "events", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = reference.QUERIES[name](spark, SF)
    r = con.execute(reference.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(got.columns)
    plain = lambda v: None if v is None else round(v, 9) if isinstance(v, float) else str(v)
    want = sorted((tuple(plain(x) for x in row) for row in r.fetchall()), key=repr)
    assert sorted((tuple(plain(row[c]) for c in names) for row in got.collect()), key=repr) == want


def test_heading_score_of_whole_lines(spark, tmp_path):
    long = "a heading of far more than forty characters that ends with a mark"
    spark.createDataFrame([(1, f"{long}.\n{long}\nTITLE")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.pos: r.score for r in reference.QUERIES["heading_score_lines"](spark, str(tmp_path)).collect()}
    assert got == {0: 0.0, 1: pytest.approx(1 / len(long.split())), 2: 4.0}


def test_label_resolve_covers_all_documents(spark):
    docs = reference.table(spark, SF, "documents")
    assert reference.QUERIES["label_resolve"](spark, SF).select("list_id").distinct().count() == docs.select("doc_id").distinct().count()


def rows_of(spark, column, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column).collect()]


def test_lookups(spark):
    v = F.col("v")
    assert rows_of(spark, lookups.sub_id(v), ["(1)", "(2 bis)", "3 ter", "(a)", "4 foo", "(b).", None]) == ["1", "22", "33", "a", "4", "b", None]
    assert rows_of(spark, lookups.delimited(v), ["A", "EBA", "bank"]) == [r"\bA\b", r"\bEBA\b", r"\bbank[a-z]{0,2}\b"]
    assert rows_of(spark, lookups.hosted_path(v), ["32013R0575", "313R0575", "396L0010", "52013PC0001", None]) == ["/eu/32013R0575/", "/eu/32013R0575/", "/eu/31996L0010/", None, None]
    assert rows_of(spark, lookups.corrigendum_number(v), ["32013R0575R(02)", "32013R0575"]) == ["(02)", None]
    assert rows_of(spark, lookups.language_of_two(v), ["ENG", "ell", "xxx"]) == ["EN", "EL", None]
    assert rows_of(spark, lookups.state_after(v), [None, "repealer", "not_found", "other"]) == ["success", "repealer", "impossible", "failed"]
    assert rows_of(spark, lookups.expanded(v, readers.PREFIXES), ["eli:in_force", "res-celex:3", "http://x"]) == ["http://data.europa.eu/eli/ontology#in_force", "http://publications.europa.eu/resource/celex/3", "http://x"]
    assert rows_of(spark, lookups.seconds_to_tomorrow(v.cast("timestamp")), ["2020-01-31 23:59:50", "2020-02-28 00:00:00"]) == [10, 86400]
    assert rows_of(spark, lookups.known(v.cast("double")), ["1.5", "NaN", None]) == [1.5, None, None]
    assert rows_of(spark, lookups.human_id(F.nullif(v, F.lit("")), F.lit("3X")), ["Reg. 1", ""]) == ["Reg. 1", "CELEX:3X"]
    assert rows_of(spark, lookups.guessed_url(F.lit("32013R0575"), v.cast("date"), F.lit("EN"), "PDF"), ["1900-01-01", "2020-02-03"]) == [f"https://eur-lex.europa.eu/legal-content/EN/TXT/PDF/?uri=CELEX:{c}" for c in ("32013R0575", "02013R0575-20200203")]
    two = {(r.side, r.key): r.value for r in lookups.both_ways(spark.createDataFrame([("a", "1"), ("b", "2")], "l string, r string"), "l", "r").collect()}
    assert two == {("l", "a"): "1", ("l", "b"): "2", ("r", "1"): "a", ("r", "2"): "b"}
    labels = spark.createDataFrame([("X", "label")], "key string, label string")
    assert {r.i: r.label for r in lookups.iri_labels(spark.createDataFrame([("p/X",), ("q/X",), ("p/Y",)], "i string"), "i", "p/", labels).collect()} == {"p/X": "label", "q/X": None, "p/Y": None}
    treaties = spark.createDataFrame([("TFEU", "EN", "TFEU")], "treaty string, language string, abbrev string")
    assert lookups.acronyms(treaties.select("treaty", "language"), treaties).first().abbrev == "TFEU"
    with pytest.raises(Exception, match="no acronym"):
        lookups.acronyms(spark.createDataFrame([("TEU", "EN")], "treaty string, language string"), treaties).collect()
    there, gone = lookups.anchors_of(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, "/eu/1/")], "id int, href string"), "id")
    assert [tuple(r) for r in there.collect()] == [(1, "/eu/1/")] and [r.id for r in gone.collect()] == [2]
    old = spark.createDataFrame([(1, None, ["a"]), (2, "t", None)], "id int, title string, cites array<string>")
    new = spark.createDataFrame([(1, "new", ["b", "a"]), (2, "other", ["c"])], "id int, title string, cites array<string>")
    assert {r.id: (r.title, r.cites) for r in lookups.coalesce_records(old, new, "id", ["cites"]).collect()} == {1: ("new", ["a", "b"]), 2: ("t", ["c"])}
    record = spark.createDataFrame([(1, "t", "", "h", None)], "id int, title string, empty string, _hidden string, none string")
    assert [tuple(r) for r in lookups.filled(record, "id").collect()] == [(1, "title", "t")]
    a = spark.range(1).select(lookups.treaty_anchor(["TEU"], F.lit("TEU"), F.lit("http://s"), F.lit("TEU"), F.lit("Treaty")).alias("a"), lookups.treaty_anchor([], F.lit("TEU"), F.lit("http://s"), F.lit("TEU"), F.lit("Treaty")).alias("b"), lookups.internal(F.array(F.lit("/eu/1/"), F.lit("http://x"))).alias("c")).first()
    assert a.a.href == "/eu/TEU/" and a.b.href == "http://s" and a.c == ["/eu/1/"]


def test_registry_rows(spark):
    hits = spark.createDataFrame([
        ("32013R0575", 1, "EN", None, "t", "2013-06-26", "u1"), ("32013R0575", 2, "DE", True, None, "2013-06-26", "u2"), ("32013R0575", 3, "EN", None, None, None, "u3"),
        ("02014L0065-20200326", 4, "EN", None, "c", None, "u4"), ("32013R0575R(02)", 5, "EN", None, "k", "2013-08-02", "u5"), ("32015R0001R(01)", 6, "DE", None, "k", "2016-01-01", "u6"),
    ], "celex string, ord int, language string, in_force boolean, title string, date string, url string").withColumn("date", F.to_date("date"))
    made = {k: {tuple(str(x) for x in r) for r in v.collect()} for k, v in registry.register(hits).items()}
    acts = {r.celex: r for r in registry.register(hits)["act"].collect()}
    assert set(acts) == {"32013R0575", "32014L0065", "32015R0001"} and acts["32013R0575"].in_force is True and acts["32013R0575"].title == "t" and acts["32014L0065"].title is None
    assert ("32014L0065", "2020-03-26") in made["version"] and ("32014L0065", "2020-03-26", "EN", "u4") in made["representation"] and ("32013R0575", "2013-06-26", "DE", "u2") in made["representation"]
    assert made["corrigendum"] == {("32013R0575R(02)", "32013R0575", "2013-08-02"), ("32015R0001R(01)", "32015R0001", "2016-01-01")} and len(made["correpresentation"]) == 2
    old = spark.createDataFrame([("a", 1, None)], "k string, x int, y string")
    new = spark.createDataFrame([("a", 2, "p"), ("a", None, "q"), ("b", 3, None)], "k string, x int, y string")
    assert {tuple(r) for r in registry.upsert(old, new, ["k"], ["x"]).collect()} == {("a", 2, "q"), ("b", 3, None)}
    sent = {r.id: r.sent for r in writers.send(spark.range(4), lambda: lambda row: row["id"] % 2 == 0).collect()}
    assert sent == {0: True, 1: False, 2: True, 3: False}
