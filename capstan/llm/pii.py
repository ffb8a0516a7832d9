"""Personal data: fixed patterns, and terms that give away whom they stand beside; DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.llm.texts import documents_of
from capstan.llm.workspace import Workspace

KINDS = ("email", "ip", "card", "phone")
# The patterns, with possessive runs and starts that cannot lie inside a run that failed.
# \\G lets a match begin where the one before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A card's single separators are made this mark first, so that its digits are one run.
MARK, OTHER_MARK = "\u0001", "\u0002"
CARD = f"[0-9][0-9{MARK}]+"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"\p{L}[\p{L}\p{N}]*+"

# Code points on either side of an entity in which a term counts as beside it.
REACH = 120
# A term is generalised, or removed, if it tells this share of an entity's information.
GENERALISE, REMOVE = 0.85, 0.97
# Different surroundings in which a term must stand beside an entity, in more than one document:
# copies of one are no evidence.
SUPPORT = 2
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
NAME_TAG, TERM_TAG = "[NAME]", "[TERM]"
_SPAN = "struct<start:int,end:int,value:string>"
# Matches whose places are added up together.
AT_ONCE = 64


def _places(pairs: Column, begin: Column) -> Column:
    """``start, end, value`` of (piece, value) pairs that follow one another from a place on."""
    start = F.struct(begin.alias("at"), F.expr(f"CAST(array() AS array<{_SPAN}>)").alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, start, step, lambda s: s["spans"])


def occurrences(text: Column, pattern: str) -> Column:
    """``start, end, value`` of all matches, left to right, in code points.

    Matches and the pieces between them come from the same matcher, so their
    lengths add up to the places. Many are added up ``AT_ONCE`` at a time, each
    group from where the one before ends: a list that grows is copied with every
    entry, so one of all matches would cost their square.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, v: F.struct(p.alias("piece"), v.alias("value"))
    )
    numbers = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / AT_ONCE).cast("int"))
    groups = F.transform(numbers, lambda n: F.slice(pairs, n * AT_ONCE + 1, F.lit(AT_ONCE)))

    def size(group: Column) -> Column:
        return F.aggregate(group, F.lit(0), lambda n, p: n + F.length(p["piece"]) + F.length(p["value"]))

    ends = F.aggregate(
        F.transform(groups, size), F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
    )
    many = F.flatten(F.zip_with(groups, F.slice(ends, F.lit(1), F.size(numbers)), _places))
    none = F.expr(f"CAST(array() AS array<{_SPAN}>)")
    few = F.size(found) <= AT_ONCE
    return F.when(F.size(found) == 0, none).when(few, _places(pairs, F.lit(0))).otherwise(many)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    backward = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(place: Column) -> Column:
        digit = F.substring(backward, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(place % 2 == 1, digit).otherwise(twice)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind that hold what the kind asks for."""
    digits_of = F.regexp_replace
    single = F.regexp_replace(F.translate(text, MARK, OTHER_MARK), r"(?<=[0-9])[\x20-](?=[0-9])", MARK)

    def card(s: Column) -> Column:
        digits = F.translate(s["value"], MARK, "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)

    def phone(s: Column) -> Column:
        return F.length(digits_of(s["value"], r"[^0-9]", "")).between(8, 15)

    return {
        "email": F.when(F.contains(text, F.lit("@")), occurrences(text, EMAIL)).otherwise(
            F.expr(f"CAST(array() AS array<{_SPAN}>)")
        ),
        "ip": F.filter(occurrences(text, IP), lambda s: s["value"].rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        "card": F.filter(occurrences(single, CARD), card),
        "phone": F.filter(occurrences(text, PHONE), phone),
    }


def _tagged(spans: Column, kind: str) -> Column:
    """Spans with their kind and the entity they name: letters lowered, numbers by their digits."""

    def entity(s: Column) -> Column:
        name = F.lower(s["value"]) if kind in ("email", "ip") else F.regexp_replace(s["value"], "[^0-9]", "")
        return F.concat(F.lit(kind + ":"), name)

    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), entity(s).alias("entity")
        ),
    )


def find_base(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text, base``: spans by kind as listed, then by start."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    return rows.select("doc_id", "mark", "text", F.concat(*[_tagged(F.col(k), k) for k in KINDS]).alias("base"))


def _beside(found: DataFrame, reach: int) -> DataFrame:
    """Terms within ``reach`` of each entity: ``doc_id, mark, entity, surroundings, term, start, end``."""
    rows = found.where(F.size("base") > 0).select("doc_id", "mark", "text", "base", F.inline("base"))
    size = F.length("text")
    left = F.greatest(F.lit(0), F.col("start") - reach)
    right = F.least(size, F.col("end") + reach)
    before = F.substring("text", left + 1, F.col("start") - left)
    after = F.substring("text", F.col("end") + 1, right - F.col("end"))
    rows = rows.select(
        "doc_id", "mark", "entity", "base", left.alias("left"), F.col("end").alias("right"),
        before.alias("before"), after.alias("after"), (left > 0).alias("cut_left"), (right < size).alias("cut_right"),
        F.xxhash64(before, after).alias("surroundings"),
    )

    def placed(side: str, offset: str) -> Column:
        return F.transform(
            occurrences(F.col(side), TERM),
            lambda t: F.struct(
                F.lower(t["value"]).alias("term"), (t["start"] + F.col(offset)).alias("start"),
                (t["end"] + F.col(offset)).alias("end"), t["value"].alias("value"),
            ),
        )

    # A word that the edge of the reach may have cut is left out.
    first = F.filter(placed("before", "left"), lambda t: ~F.col("cut_left") | (t["start"] > F.col("left")))
    last = F.filter(
        placed("after", "right"), lambda t: ~F.col("cut_right") | (t["end"] < F.col("right") + F.length("after"))
    )
    free = F.filter(
        F.concat(first, last), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return rows.select("doc_id", "mark", "entity", "surroundings", F.inline(free))


def disclosure(work: Workspace, docs: DataFrame, beside: DataFrame, support: int, generalise: float) -> DataFrame:
    """``term, entity, share``: how much of an entity's information a term gives, where it is too much.

    Over all occurrences of words in the corpus: information IC(c) = -log p(c)
    of standing beside entity c, and PMI(c; t) = log p(c | t) / p(c). ``share`` is
    PMI / IC, one for a term that stands nowhere else. Counts are combined
    before each shuffle.
    """
    ends = [F.min("doc_id").alias("first"), F.max("doc_id").alias("last")]
    spots = beside.groupBy("term", "entity", "surroundings").agg(F.count(F.lit(1)).alias("n"), *ends)
    pairs = spots.groupBy("term", "entity").agg(
        F.sum("n").alias("both"),
        F.count(F.lit(1)).alias("different"),
        (F.min("first") < F.max("last")).alias("spread"),
    )
    pairs = work.store(pairs, "pairs")
    # The words of an address are the entity's own.
    outside = F.when(F.contains("text", F.lit("@")), F.regexp_replace("text", EMAIL, " ")).otherwise(F.col("text"))
    words = F.explode(F.regexp_extract_all(F.lower(outside), F.lit(TERM), F.lit(0))).alias("term")
    counts = work.store(docs.select(words).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    entities = pairs.groupBy("entity").agg(F.sum("both").alias("around"))
    likely = pairs.where((F.col("different") >= support) & F.col("spread")).join(counts, "term").join(entities, "entity")
    # Both logs are of shares of the total; an entity that fills the corpus has no information to give.
    information = F.log(F.lit(float(max(total, 1)))) - F.log("around")
    gained = F.log("both") + F.log(F.lit(float(max(total, 1)))) - F.log("n") - F.log("around")
    share = F.when(information > 0, gained / information).otherwise(0.0)
    return likely.select("term", "entity", share.alias("share")).where(F.col("share") >= generalise)


def telling_terms(
    work: Workspace, docs: DataFrame, found: DataFrame, reach: int, support: int, generalise: float, remove: float
) -> DataFrame:
    """``doc_id, mark, terms`` of the documents that hold words telling too much of an entity they hold.

    What a word tells is estimated within ``reach`` of the entity, over the
    corpus; it then goes wherever it stands in a document with that entity.
    """
    beside = work.store(_beside(found, reach), "beside")
    telling = work.store(disclosure(work, docs, beside, support, generalise), "telling")
    keys = ["doc_id", "mark"]
    held = found.select(*keys, F.explode(F.array_distinct(F.transform("base", lambda b: b["entity"]))).alias("entity"))
    told = held.join(telling, "entity").groupBy(*keys, "term").agg(F.max("share").alias("share"))
    told = work.store(told, "told")
    texts = found.join(told.select(*keys).distinct().hint("merge"), keys, "left_semi")
    words = texts.select(*keys, "base", F.inline(occurrences(F.col("text"), TERM)))
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    words = words.where(free).select(*keys, "start", "end", "value", F.lower("value").alias("term"))
    spots = words.join(told.hint("merge"), [*keys, "term"])
    entry = F.struct("start", "end", "value", (F.col("share") >= remove).alias("removed"))
    terms = spots.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("terms"))
    terms = work.store(terms, "terms")
    work.drop("beside", "pairs", "counts", "telling", "told")
    return terms


def entities(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text, base`` of the documents that hold personal data, each once."""
    found = find_base(docs).where(F.size("base") > 0)
    first = F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("doc_id"))
    return found.withColumn("row", first).where("row = 1").drop("row")


def _or_none(terms: str) -> Column:
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string,removed:boolean>>)")
    return F.coalesce(F.col(terms), none)


def find(
    docs: DataFrame,
    reach: int = REACH,
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, mark, base, terms`` of every document (``mark``: the hash of its text).

    ``base`` has ``kind, start, end, entity``; starts and ends count code points.
    ``terms`` has ``start, end, value, removed``: words that, standing within
    ``reach`` of an entity, tell at least ``generalise`` of its information over
    the corpus, wherever they stand in a document that holds it; from ``remove``
    on they are to go, below that to be made general.

    A null text counts as empty and has no spans; repeated rows count each and
    give repeated rows; rows without an id take no part; an empty table gives an
    empty one; other columns are not read. Windows and counts cover whole texts.
    """
    docs = documents_of(docs, id_col, text_col)
    work = Workspace(docs.sparkSession)
    found = work.store(entities(docs), "found")
    terms = telling_terms(work, docs, found, reach, support, generalise, remove)
    spans = work.store(found.select("doc_id", "mark", "base"), "spans").join(terms, ["doc_id", "mark"], "left")
    work.drop("found")
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark")).join(spans.hint("merge"), ["doc_id", "mark"], "left")
    none = F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int,entity:string>>)")
    return rows.select("doc_id", "mark", F.coalesce("base", none).alias("base"), _or_none("terms").alias("terms"))


def sanitised(text: Column, base: Column, terms: Column) -> Column:
    """The text with entities as tags, telling terms as general words or gone; overlapping spans count as the first."""
    tag = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])

    def of_term(t: Column) -> Column:
        upper = F.substring(t["value"], 1, 1) != F.lower(F.substring(t["value"], 1, 1))
        word = F.when(t["removed"], "").when(upper, NAME_TAG).otherwise(TERM_TAG)
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), word.alias("put"))

    spans = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), tag[b["kind"]].alias("put"))),
        F.transform(terms, of_term),
    )
    state = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        parts = F.when(s["start"] >= done["at"], F.concat(done["parts"], F.array(between, s["put"])))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), parts.otherwise(done["parts"]).alias("parts")
        )

    def end(done: Column) -> Column:
        rest = F.substring(text, done["at"] + 1, F.length(text))
        return F.concat(F.array_join(done["parts"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(F.sort_array(spans), state, step, end)).otherwise(text)


def sanitise(
    docs: DataFrame,
    reach: int = REACH,
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``text_col`` sanitised: see ``find`` and ``sanitised``.

    A null text stays null. Rows without an id have their entities replaced but
    no telling words; columns go through.
    """
    work, known = Workspace(docs.sparkSession), documents_of(docs, id_col, text_col)
    found = work.store(entities(known), "found")
    terms = telling_terms(work, known, found, reach, support, generalise, remove)
    work.drop("found")
    terms = terms.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("terms").alias("__terms"))
    text, id_ = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    keys = (id_ == F.col("__id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__mark"))
    spans = F.concat(*[_tagged(c, k) for k, c in base_spans(text).items()])
    rows = docs.join(terms.hint("merge"), keys, "left").withColumn("__base", spans)
    clean = sanitised(text, F.col("__base"), _or_none("__terms")).alias(text_col)
    return rows.select(*[clean if c == text_col else F.col(f"`{c}`") for c in docs.columns])
