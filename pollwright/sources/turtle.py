"""Surveys written as Turtle: triples, questions and answers as tables.

Only the dialect surveys are stored in is read: statements that start a line
with ``:Subject`` and end in a full stop, with quoted or bare objects. Group
nodes find their respondent inside the document's own row, so no join and no
shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the dialect ----------------------------------------------
_STRING = r'"(?:[^"\\]|\\.)*+"'
STATEMENT = rf"(?ms)^:\w++\s++[^\".]*+(?:(?:{_STRING}|\.(?!\s|\z))[^\".]*+)*+\.(?=\s|\z)"
SUBJECT = r"\A:(\w+)"
OBJECT = rf'(?s){_STRING}|[^\s;,"]++'
PAIR = rf'(?s)(?<=\s)(?:a|\w+:\w+)\s++(?:{_STRING}|[^\s;,"]++)(?:\s*+,\s*+(?:{_STRING}|[^\s;,"]++))*+'
RESPONDENT = r"\ARespondent(.+)\z"
NODE = r"\ARespondent[^_]+_"
GROUP_LINK = "pred:hasGroupResponse"
LABEL = r"(?i)\Apred:(?:text|basequestion)\z"
# ----------------------------------------------------------------------------

DOCUMENT = ["dataset", "task", "format", "case_id"]


def turtle_key(name: Column) -> Column:
    """A question key the way Turtle spells it."""
    return F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9]+", "_"), F.lit("_"))


def _plain(obj: Column) -> Column:
    """A quoted string's content; names lose their colon."""
    inner = F.regexp_replace(
        F.substring(obj, F.lit(2), F.length(obj) - 2), r"(?s)\\(.)", "$1"
    )
    return F.when(obj.startswith('"'), inner).when(obj.startswith(":"), F.substring(obj, F.lit(2), F.length(obj))).otherwise(obj)


def _statement_triples(statement: Column) -> Column:
    # The full stop goes; a blank in front lets every pair follow whitespace.
    body = F.regexp_replace(statement, r"(?s)\A:\w+(?=\s)|\.\z", "")
    subject = F.regexp_extract(statement, SUBJECT, 1)

    def triples(pair: Column) -> Column:
        predicate = F.regexp_extract(pair, r"\A(\S+)", 1)
        objects = F.regexp_extract_all(
            F.substring(pair, F.length(predicate) + 1, F.length(pair)), F.lit(OBJECT), 0
        )
        return F.transform(
            objects,
            lambda o: F.struct(
                subject.alias("subject"), predicate.alias("predicate"), _plain(o).alias("object")
            ),
        )

    return F.flatten(F.transform(F.regexp_extract_all(body, F.lit(PAIR), 0), triples))


def _all_triples(content: Column) -> Column:
    statements = F.regexp_extract_all(content, F.lit(STATEMENT), 0)
    return F.flatten(F.transform(statements, _statement_triples))


def triples(documents: DataFrame) -> DataFrame:
    """(subject, predicate, object) rows in document order."""
    return documents.select(
        *DOCUMENT, F.posexplode(_all_triples(F.col("content"))).alias("pos", "_t")
    ).select(*DOCUMENT, "pos", "_t.subject", "_t.predicate", "_t.object")


def _said(documents: DataFrame) -> DataFrame:
    """What is said of respondents and group nodes, with the owners of a node.

    ``_loose`` tells nodes that hang on nobody: named after a respondent of
    the document, but without a link.
    """
    rows = documents.select(*DOCUMENT, _all_triples(F.col("content")).alias("_triples"))
    said = F.filter(
        "_triples",
        lambda t: t["subject"].startswith("Respondent")
        & t["predicate"].startswith("pred:")
        & (t["predicate"] != GROUP_LINK),
    )
    rows = rows.withColumns(
        {"_links": F.filter("_triples", lambda t: t["predicate"] == GROUP_LINK), "_said": said}
    ).withColumn("_subjects", F.array_distinct(F.transform("_said", lambda t: t["subject"])))

    def owners(node: Column) -> Column:
        return F.array_distinct(
            F.transform(F.filter("_links", lambda t: t["object"] == node), lambda t: t["subject"])
        )

    # looked up once a subject, before rows are spread: filters on the result can't repeat it
    known = F.transform("_subjects", lambda s: F.struct(s.alias("node"), owners(s).alias("owners")))
    at = lambda t: F.array_position("_subjects", t["subject"]).cast("int")
    spread = rows.withColumn("_known", known).select(
        *DOCUMENT,
        "_subjects",
        F.posexplode(
            F.transform("_said", lambda t: F.struct(t.alias("t"), F.element_at("_known", at(t))["owners"].alias("owners")))
        ).alias("pos", "_s"),
    )
    named = F.rtrim(F.regexp_extract(F.col("_s.t.subject"), NODE, 0), F.lit("_"))
    loose = (F.size("_s.owners") == 0) & F.array_contains("_subjects", named)
    return spread.select(
        *DOCUMENT, "pos", F.col("_s.t").alias("_t"), F.col("_s.owners").alias("_owners"), loose.alias("_loose")
    )


def answers(documents: DataFrame) -> DataFrame:
    """One row per answer; a group node's answers go to each respondent it hangs on.

    Nodes that hang on nobody are left out; :func:`unlinked` lists them.
    """
    node, linked = F.col("_t.subject"), F.size("_owners") > 0
    rows = _said(documents).filter(~F.col("_loose")).withColumn(
        "_owner", F.explode(F.when(linked, F.col("_owners")).otherwise(F.array(node)))
    )
    below = F.when(
        node.startswith(F.concat(F.col("_owner"), F.lit("_"))),
        F.substring(node, F.length("_owner") + 2, F.length(node)),
    ).otherwise(F.regexp_replace(node, NODE, ""))
    return rows.select(
        *DOCUMENT,
        F.regexp_extract("_owner", RESPONDENT, 1).alias("respondent_id"),
        "pos",
        F.when(linked, below).alias("q_group"),
        F.substring(F.col("_t.predicate"), F.lit(6), F.length("_t.predicate")).alias("q_key"),
        F.col("_t.object").alias("value"),
    )


def unlinked(documents: DataFrame) -> DataFrame:
    """Group nodes with answers that hang on no respondent."""
    return _said(documents).filter("_loose").select(*DOCUMENT, F.col("_t.subject").alias("node")).distinct()


def questions(documents: DataFrame) -> DataFrame:
    """One row per question or question group, its label unparsed."""
    rows = documents.select(*DOCUMENT, _all_triples(F.col("content")).alias("_triples"))
    groups = F.filter("_triples", lambda t: t["predicate"] == "qg:hasSubQuestion")
    rows = rows.withColumns(
        {
            "_subs": F.transform(groups, lambda t: t["object"]),
            "_heads": F.transform(groups, lambda t: t["subject"]),
        }
    )
    labels = F.filter("_triples", lambda t: t["predicate"].rlike(LABEL))
    spread = rows.select(*DOCUMENT, "_subs", "_heads", F.posexplode(labels).alias("pos", "_t"))
    at = (F.array_position("_subs", F.col("_t.subject")) - 1).cast("int")
    # Names read Q<key>, QG<group> and, below a group, Q<group>_<key>.
    head = F.when(at >= 0, F.get("_heads", at))
    group = F.substring(head, F.lit(3), F.length(head))
    name = F.col("_t.subject")
    is_group = F.lower(F.col("_t.predicate")) == "pred:basequestion"
    key = (
        F.when(is_group, F.substring(name, F.lit(3), F.length(name)))
        .when(group.isNotNull(), F.substring(name, F.length(group) + 3, F.length(name)))
        .otherwise(F.substring(name, F.lit(2), F.length(name)))
    )
    return spread.select(
        *DOCUMENT, "pos", group.alias("q_group"), key.alias("q_key"), F.col("_t.object").alias("label")
    )
