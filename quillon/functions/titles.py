"""Titles of acts as column expressions: date, essence, readable id, amended and repealed acts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillon.functions.text import spanish_ordinal

#: Months by language, then what announces a date, an amendment and a repeal.
MONTHS = {
    "EN": "January February March April May June July August September October November December".split(),
    "ES": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
    "DE": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split(),
}
DATES = {"EN": r"([0-9]{1,2})\.?\s(%s)\s([0-9]{4})", "ES": r"([0-9]{1,2})\sde\s(%s)\sde\s([0-9]{4})", "DE": r"([0-9]{1,2})\.\s(%s)\s((?:19|20)[0-9]{2})"}
AMENDING = {"EN": "(,| and )?amending ", "ES": "((y )?por (el|la) que se |que |y se )?modifican?", "DE": "((und)? zur )?(Abä|Ä)nderung"}
REPEALING = {"EN": "(,| and )?repealing ", "ES": "((y )?por (el|la) que se |que |y se )?deroga", "DE": "((und)? zur )?Aufhebung"}
#: The mark around an essence, endings of titles, and repairs of a marked title in this order.
MARK = ('<p class="lxp-title_essence">', "</p>")
ENDINGS = ("Text with EEA relevance", "Text von Bedeutung für den EWR")
REPAIRS = (
    ("</p>,", ",</p>"),
    (" zur</p> ", "</p> zur "),
    (MARK[0] + "Zur</p>", "zur"),
    (" " + MARK[0] + ")", ") " + MARK[0]),
    ("( ", " ("),
    (MARK[0] + " )", ") " + MARK[0]),
    (" sowie zur</p> ", "</p> sowie zur "),
)
#: Kinds of acts: letter in the id, and how each language names one or several of them.
KINDS = {
    "F": {"EN": "framework decisions?", "ES": "decisi[oó]n(?:es)? marco", "DE": "rahmenbeschl[uü]ss(?:es|e)?"},
    "R": {"EN": "regulations?", "ES": "reglamentos?", "DE": "verordnung(?:en)?"},
    "L": {"EN": "directives?", "ES": "directivas?", "DE": "richtlinien?"},
    "D": {"EN": "decisions?", "ES": "decisi[oó]n(?:es)?", "DE": "beschluss(?:es)?|beschlüsse|entscheidung(?:en)?"},
}
NUMBER = {"EN": "Nos?", "ES": "n\\.?os?|n\\.?[ºo]s?|№", "DE": "Nrn?\\."}
_BODY = r"(?<![0-9/])([0-9]{1,4})/([0-9]{1,4})(?:/[\p{Lu}]{2,9})?(?![0-9/])"


def _known(language: str) -> str:
    if language not in MONTHS:
        raise ValueError(f"titles in {language} are unsupported")
    return language


def _references(text: Column, language: str) -> Column:
    """Ids of the acts a text names, in order, repeated ones too.

    A kind holds for all numbers after it. A number after 'No' stands before its year, and so do the others
    after 'Nos'; elsewhere the year is first, unless only the second part can be one. Years of two digits are
    of 1945 to 2044.
    """
    kinds = "|".join(f"(?:{k[language]})" for k in KINDS.values())
    pieces = F.regexp_extract_all(text, F.lit(rf"(?iu)\b(?:{kinds})\b|(?:(?:{NUMBER[language]}) ?)?{_BODY}|\b(?:Nos|Nrn\.)"), F.lit(0))
    no_act = F.array().cast("array<string>")
    start = F.struct(F.lit(None).cast("string").alias("kind"), F.lit(False).alias("many"), no_act.alias("acts"))

    def step(s: Column, piece: Column) -> Column:
        kind = F.lit(None).cast("string")
        for letter, names in reversed(KINDS.items()):
            kind = F.when(piece.rlike(f"(?iu)^(?:{names[language]})$"), letter).otherwise(kind)
        many = piece.rlike(r"^(?i:Nos|Nrn\.|n\.?os)")
        a, b = F.regexp_extract(piece, _BODY, 1), F.regexp_extract(piece, _BODY, 2)
        year = r"^([0-9]{2}|(19|20)[0-9]{2})$"
        behind = piece.rlike(rf"^(?iu:{NUMBER[language]})") | s["many"] | (~a.rlike(year) & b.rlike(year))
        y, n = F.when(behind, b).otherwise(a), F.when(behind, a).otherwise(b)
        whole = F.when(F.length(y) < 3, F.concat(F.when(y < "45", "20").otherwise("19"), F.lpad(y, 2, "0"))).otherwise(y)
        act = F.concat(F.lit("3"), F.lpad(whole, 4, "0"), s["kind"], F.lpad(n, 4, "0"))
        numbered = (a != "") & s["kind"].isNotNull()
        return F.struct(F.coalesce(kind, s["kind"]).alias("kind"), F.when(kind.isNotNull(), False).otherwise(s["many"] | many).alias("many"), F.when(numbered, F.array_append(s["acts"], act)).otherwise(s["acts"]).alias("acts"))

    return F.aggregate(pieces, start, step, lambda s: s["acts"])


def clean_references(references: Column) -> Column:
    """Document ids without their PND_ or DID_; parts of documents (PRE_, ART_, ANX_) are dropped."""
    return F.transform(F.filter(references, lambda r: ~r.rlike("^(PRE|ART|ANX)_")), lambda r: F.regexp_replace(r, "^(PND|DID)_", ""))


def readable_id(text: Column, language: str) -> Column:
    """The first act that a text names, with only the kind's first letter in upper case; null if there is none."""
    kinds = "|".join(f"(?:{k[_known(language)]})" for k in KINDS.values())
    found = F.regexp_extract(text, rf"(?iu)\b(?:{kinds})(?: \([^()]{{2,20}}\))?(?: (?:{NUMBER[language]}))? ?{_BODY}", 0)
    return beautify(F.nullif(found, F.lit("")))


def beautify(id_human: Column) -> Column:
    """'REGULATION (EU) ..' as 'Regulation (EU) ..'; ids of letters and blanks alone stay."""
    word = F.regexp_extract(id_human, "^[^ ]*", 0)
    made = F.concat(F.upper(F.substr(word, F.lit(1), F.lit(1))), F.lower(F.substr(word, F.lit(2))), F.substr(id_human, F.length(word) + 1))
    return F.when(id_human.rlike(r"^[\p{L} ]*$"), id_human).otherwise(made)


def decision_word(id_human: Column, title: Column) -> Column:
    """German decisions are called what the title calls them."""
    return F.when(title.contains("Beschluss"), id_human).otherwise(F.replace(id_human, F.lit("Beschluss "), F.lit("Entscheidung ")))


def parse(title: Column, language: str) -> Column:
    """A struct of date_document, title_essence, id_human, amends and repeals. EN, ES and DE; others are refused.

    The essence stands between the date and the first amendment or repeal. What a title lacks is null, or an
    empty list; of a null title all fields are null.
    """
    _known(language)
    t = F.regexp_replace(title, r"(?U)\s", " ")
    at = lambda p: F.nullif(F.regexp_instr(t, F.lit(f"(?iu){p}")), F.lit(0))
    dated = "(?iu)" + DATES[language] % "|".join(MONTHS[language])
    part = lambda n: F.regexp_extract(t, dated, n)
    month = F.lpad(F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS[language]]), F.lower(part(2))).cast("string"), 2, "0")
    day = F.concat_ws("-", part(3), month, F.lpad(part(1), 2, "0")).try_cast("date")
    a, r, end = at(AMENDING[language]), at(REPEALING[language]), F.length(t) + 1
    stop = F.least(F.coalesce(a, end), F.coalesce(r, end))
    begin = F.when(part(0) != "", F.regexp_instr(t, F.lit(dated)) + F.length(part(0)) + 1).otherwise(F.lit(1))
    essence = F.regexp_replace(F.substr(t, begin, F.greatest(stop - begin, F.lit(0))), r"^[ \n,;:.]+|[ \n,;:.]+$", "")
    essence = F.regexp_replace(F.concat(F.upper(F.substr(essence, F.lit(1), F.lit(1))), F.substr(essence, F.lit(2))), "(?i) ?zur ?$", "")
    upto = lambda start, other: F.substr(t, start, F.when(other > start, other - start).otherwise(end - start))
    acts = lambda start, other: F.when(t.isNotNull(), F.coalesce(clean_references(_references(upto(start, other), language)), F.array().cast("array<string>")))
    head = decision_word(readable_id(F.substr(t, F.lit(1), stop - 1), language), t)
    return F.struct(day.alias("date_document"), F.when(F.trim(essence) != "", essence).alias("title_essence"), head.alias("id_human"), acts(a, r).alias("amends"), acts(r, a).alias("repeals"))


def mark_essence(title: Column, essence: Column) -> Column:
    """The title with its essence marked; unchanged where it has a mark already or doesn't hold the essence."""
    start = F.position(F.trim(F.lower(essence)), F.lower(title))
    size = F.length(F.trim(essence))
    marked = F.concat(F.substr(title, F.lit(1), start - 1), F.lit(MARK[0]), essence, F.lit(MARK[1]), F.substr(title, start + size))
    rules = list(REPAIRS)
    for ending in ENDINGS:
        rules += [(f" ({ending})</p>", f"</p> ({ending})"), (f" {ending}</p>", f"</p> ({ending})"), (f" ({ending}. )</p>", f"</p> ({ending})"), (f" {ending}", f" ({ending})")]
    for old, new in rules:
        marked = F.replace(marked, F.lit(old), F.lit(new))
    return F.when(essence.isNull() | (start == 0) | title.contains(MARK[0]), title).otherwise(marked)


def title_data(title: Column, id_human: Column, fallback: Column, language: str) -> Column:
    """A struct of title, id_human and title_essence for a record: old marks go, the essence is marked, and the
    readable id is the title's, else the known one, else the fallback (made from the local id)."""
    plain = F.replace(F.replace(title, F.lit(MARK[0]), F.lit("")), F.lit(MARK[1]), F.lit(""))
    plain = spanish_ordinal(plain) if language == "ES" else plain
    found = parse(plain, language)
    return F.struct(mark_essence(plain, found["title_essence"]).alias("title"), F.coalesce(found["id_human"], id_human, fallback).alias("id_human"), found["title_essence"].alias("title_essence"))
