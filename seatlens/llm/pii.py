"""Personal data: seed patterns, and a bootstrapped contextual extraction on top.

Strict patterns give the seeds (the base spans). Every identifier-like word of the
corpus, one with a digit or an at sign, is an instance, and the words around it are
lexical patterns: the two words before, the word before with the word after, and a
word before that ends in a colon, an equals sign or a hash. Patterns and instances
form a graph, aggregated over the whole corpus. In each round a pattern is scored
by how many distinct known instances of a kind it has among all its instances, an
instance by its patterns, and confident instances count as known in the next
round. Instances that were not seeds, have the shape of their kind and reach the
threshold are the unseen identifiers; all their occurrences outside base spans
are added.

Only DataFrame functions run. The texts are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.llm import spans as S
from seatlens.session import stage

KINDS = ["email", "ip", "card", "phone"]

# The possessive forms and lookbehinds match what the plain patterns match from left
# to right, without trying a long run again from each of its characters.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Numbers after a word are joined to it, but not to a label that ends in a mark ("phone2: 555-0199").
WORD = r"(?<!\S)\S*?[0-9@]\S*+(?:(?<![:=#])\x20[0-9().+-]++(?!\S))*+"
# What may be the label of the numbers joined to it: "tel2", or "2 -".
LABEL = r"^(?:[0-9]{1,2}\x20-|(?=\S*?\p{L})\S++(?:\x20-)?)\x20(?=[^0-9]*[0-9])"
#: Characters around a word that its lexical patterns are taken from.
CONTEXT = 60

PATTERNS = [
    S.Pattern("email", EMAIL, "@"),
    S.Pattern("ip", IP, r"[0-9]\.[0-9]"),
    S.Pattern("card", CARD, r"[0-9][\x20-]?[0-9]"),
    S.Pattern("phone", PHONE, r"\+[0-9]"),
    S.Pattern("word", WORD, "[0-9@]", context=CONTEXT),
]

#: Rounds of scoring; a pattern needs this many distinct known instances and this share of them.
ROUNDS, SUPPORT, CONFIDENCE = 3, 5, 0.8


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def valid(kind: Column, hit: Column) -> Column:
    """Whether a match of a base pattern passes its kind's test."""
    digits = _digits(hit)
    count = F.length(digits)
    parts = hit.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{0,2})(?:\.|$)){4}$")
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", parts)
        .when(kind == "card", F.when(count.between(13, 19), F.call_function("luhn_check", digits)).otherwise(False))
        .when(kind == "phone", count.between(9, 15))
        .otherwise(False)
    )


def _seed_kind(word: Column) -> Column:
    """The kind of the base match inside an identifier-like word, or null."""
    inside = [(k, F.regexp_extract(word, p, 0)) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)]
    return F.coalesce(*[F.when((hit != "") & valid(F.lit(k), hit), F.lit(k)) for k, hit in inside])


def _shaped(kind: Column, word: Column) -> Column:
    """Whether a word looks enough like a kind to be taken on the strength of its context."""
    digits = F.length(_digits(word))
    return (
        F.when(kind == "email", word.rlike(r"[^@]@[^@]"))
        .when(kind == "ip", word.rlike(r"[0-9a-fA-F]+[.:][0-9a-fA-F]+[.:][0-9a-fA-F]+"))
        .when(kind == "card", digits >= 12)
        .when(kind == "phone", digits.between(7, 15))
        .otherwise(False)
    )


_EDGE = r"^[^A-Za-z0-9+@(]+|[^A-Za-z0-9]+$"


def _occurrences(found: DataFrame) -> DataFrame:
    """Identifier-like words, trimmed, with their lexical patterns; numbers behind a label also without it."""
    words = found.where("kind = 'word'")
    label = F.regexp_extract("hit", LABEL, 0)
    words = words.withColumn("label", F.explode(F.array_distinct(F.array(F.lit(""), label))))
    words = words.withColumn("hit", F.expr("substring(hit, char_length(label) + 1)"))
    words = words.withColumn("left", F.right(F.concat("left", "label"), F.lit(CONTEXT)))
    words = words.withColumn("start", F.col("start") + F.char_length("label"))
    words = words.withColumn("lead", F.char_length(F.regexp_extract("hit", r"^[^A-Za-z0-9+@(]*", 0)))
    words = words.withColumn("instance", F.regexp_replace("hit", _EDGE, "")).where("instance != ''")
    start = F.col("start") + F.col("lead")
    words = words.withColumn("start", start).withColumn("end", F.col("start") + F.char_length("instance"))
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    one = plain(F.regexp_extract("left", r"(\S+)\s*$", 1))
    two = plain(F.regexp_extract("left", r"(\S+\s+\S+)\s*$", 1))
    after = plain(F.regexp_extract("right", r"^\s*(\S+)", 1))
    contexts = F.array(
        F.when(two != "", F.concat(F.lit("two before: "), two)),
        F.when((one != "") & (after != ""), F.concat(F.lit("around: "), one, F.lit(" _ "), after)),
        F.when(one.rlike("[:=#]$"), F.concat(F.lit("mark: "), one)),
    )
    return words.select(*S.ROW, "start", "end", "instance", F.array_compact(contexts).alias("contexts"))


def _graph(occurrences: DataFrame) -> DataFrame:
    """Edges (context, instance) with the instance's seed kind, one per distinct pair."""
    edges = occurrences.select("instance", F.explode("contexts").alias("context")).distinct()
    return edges.withColumn("seed", _seed_kind(F.col("instance")))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(instance, kind, score) of unseen instances that confident patterns have found.

    A pattern's confidence for a kind is the share of known instances of that kind
    among all its instances, known ones of other kinds counting against it. An
    instance's score is one minus the product of its patterns' doubts.
    """
    found = None
    for _ in range(rounds):
        known = edges.withColumn("known", F.col("seed"))
        if found is not None:
            known = edges.join(found.select("instance", F.col("kind").alias("learnt")), "instance", "left")
            known = known.withColumn("known", F.coalesce("seed", "learnt"))
        size = known.groupBy("context").agg(
            F.count("*").alias("n"), *[F.count_if(F.col("known") == k).alias(k) for k in KINDS]
        )
        best = F.greatest(*[F.struct(F.col(k).alias("f"), F.lit(k).alias("kind")) for k in KINDS])
        patterns = size.select("context", "n", best.alias("b")).select("context", "b.kind", "b.f", "n")
        patterns = patterns.where((F.col("f") >= support) & (F.col("f") >= confidence * F.col("n")))
        patterns = patterns.withColumn("doubt", 1 - F.col("f") / F.col("n"))
        unseen = edges.where("seed is null").join(patterns, "context").where(_shaped(F.col("kind"), F.col("instance")))
        doubt = F.exp(F.sum(F.log(F.greatest("doubt", F.lit(1e-6)))))
        scored = unseen.groupBy("instance", "kind").agg((1 - doubt).alias("score")).where(F.col("score") >= confidence)
        top = Window.partitionBy("instance").orderBy(F.desc("score"), "kind")
        found = scored.withColumn("r", F.row_number().over(top)).where("r = 1").drop("r")
        found = stage(found, "instances")
    return found


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (id, text_hash), and their spans (id, text_hash, kind, start, end, hit, base, score).

    A null text is empty. Equal rows of ``docs`` appear once among the spans and
    as often as they occur among the rows. Overlaps between kinds stay; added
    spans overlap no base span. Other columns are ignored, whatever their names.
    """
    scanned = S.scan(S.keyed(docs, id_col, text_col), PATTERNS)
    found = S.positions(scanned, CONTEXT)
    base = found.where(valid(F.col("kind"), F.col("hit"))).select(*S.ROW, "kind", "start", "end", "hit")
    base = stage(base.withColumn("base", F.lit(True)).withColumn("score", F.lit(1.0)), "base")
    words = stage(_occurrences(found), "words")
    learnt = bootstrap(stage(_graph(words), "graph"))
    new = words.join(learnt, "instance").select(*S.ROW, "kind", "start", "end", F.col("instance").alias("hit"), "score")
    new = S.outside(new, base)
    whole = Window.partitionBy(*S.ROW, "kind", "end").orderBy("start")  # numbers with their label, if that was found
    new = new.withColumn("r", F.row_number().over(whole)).where("r = 1").drop("r")
    new = new.withColumn("base", F.lit(False))
    return scanned.select(*S.ROW), base.unionByName(new)


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone of base spans, base_sha256, spans."""
    rows, spans = personal_spans(docs, id_col, text_col)
    out = S.digests(rows, spans, KINDS, KINDS, by_kind=True)
    return out.withColumnRenamed("id", id_col).drop("text_hash")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans become one, named after the first. A null text stays null;
    all other columns stay as they are.
    """
    _, spans = personal_spans(docs, id_col, text_col)
    row = Window.partitionBy(*S.ROW).orderBy("start", F.desc("end"), "kind")
    reached = F.max("end").over(row.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") >= reached, F.lit(True))
    run = F.sum(begins.cast("int")).over(row.rowsBetween(Window.unboundedPreceding, 0))
    whole = spans.withColumn("run", run).groupBy(*S.ROW, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind")
    )
    previous = F.lag("end", 1, 0).over(Window.partitionBy(*S.ROW).orderBy("start"))
    cuts = whole.withColumn("after", previous).groupBy(*S.ROW).agg(
        F.sort_array(F.collect_list(F.struct("start", "after", "end", "kind"))).alias("cuts")
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row_hash = F.xxhash64(text)
    names = {c: f"{c}__of_spans" for c in cuts.columns}
    cuts = cuts.select(*[F.col(c).alias(n) for c, n in names.items()])
    both = docs.join(cuts, docs[id_col].eqNullSafe(F.col(names["id"])) & (row_hash == F.col(names["text_hash"])), "left")
    marks = F.col(names["cuts"])
    pieces = F.transform(
        marks,
        lambda c: F.concat(
            F.substring(docs[text_col], c["after"].cast("int") + 1, (c["start"] - c["after"]).cast("int")),
            F.lit("["), F.upper(c["kind"]), F.lit("]"),
        ),
    )
    rest = F.substring(docs[text_col], F.element_at(marks, -1)["end"].cast("int") + 1, F.char_length(docs[text_col]))
    clean = F.when(marks.isNull(), docs[text_col]).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return both.select(*[clean.alias(c) if c == text_col else docs[c] for c in docs.columns])
