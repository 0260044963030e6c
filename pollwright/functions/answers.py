"""Reading answers: marked sections, expected values, identifiers, numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.functions.text import SPACE, printed_double, strip

# --- fixed values: answer markers and identifier shapes ---------------------
ANSWER_SECTION = (
    rf"(?is)###{SPACE}*ANSWER{SPACE}*###{SPACE}*(.*?){SPACE}*###{SPACE}*END{SPACE}*###"
)
NUMBER = r"(?U)\b\d+\b"
CASE_ID = r"(?Ui)\bcase_\d+\b"
LETTER_NUMBER = r"(?U)\b[A-Za-z]\d+\b"
WORD_UNDERSCORE_NUMBER = r"(?U)\b[A-Za-z]+_\d+\b"
WORD_NUMBER = r"(?U)\b[A-Za-z]+(\d+)\b"
# ----------------------------------------------------------------------------

# Everything an identifier search keeps whole, found in one pass.
_WHOLE_IDENTIFIER = r"(?U)\b(?:\d+|[A-Za-z]\d+|[A-Za-z]+_\d+)\b"

# A bracketed list whose items are quoted strings, plain numbers or keywords.
# Possessive groups keep the match iterative, so long lists need no stack.
_STRING = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\""""
_DIGITS = r"\d(?:_?\d)*+"
_NUMBER = (
    r"[+-]?+(?:0[xX](?:_?[0-9a-fA-F])++|0[oO](?:_?[0-7])++|0[bB](?:_?[01])++"
    rf"|(?:{_DIGITS})?+\.{_DIGITS}(?:[eE][+-]?+{_DIGITS})?+|{_DIGITS}\.(?:[eE][+-]?+{_DIGITS})?+"
    rf"|{_DIGITS}[eE][+-]?+{_DIGITS}|[1-9](?:_?\d)*+|0(?:_?0)*+)"
)
_PLAIN = rf"{_NUMBER}(?=\s*+(?:,|\]))|None|True|False|null|true|false"
_ITEM = rf"(?:{_STRING}|{_PLAIN})"
_LIST = rf"(?s)\A\[\s*+(?:{_ITEM}(?:\s*+,\s*+{_ITEM})*+\s*+,?+)?+\s*+\]\z"
_ITEM_CONTENT = (
    r"""(?s)\s*+(?:'((?:[^'\\]|\\.)*+)'|"((?:[^"\\]|\\.)*+)"|([^\s,]++))\s*+,?+\s*+"""
)
_MARK, _BARE = "\u0001", "\u0002"


def answer_section(response: Column) -> Column:
    """Text between the answer and end markers, or the response as it is."""
    found = strip(F.regexp_extract(response, ANSWER_SECTION, 1))
    marked = response.contains("###") & response.rlike(ANSWER_SECTION)
    return F.when(marked, found).otherwise(response)


def _printed_keywords(text: Column) -> Column:
    """Spell bare JSON keywords the way a printed Python value spells them."""
    for word, printed in (("null", "None"), ("true", "True"), ("false", "False")):
        text = F.regexp_replace(text, rf"(?<=[\[,\s]){word}(?=\s*+[,\]])", printed)
    return text


def unquoted(expected: Column) -> Column:
    """Strip, then drop one pair of equal outer quotes and strip again."""
    bare = strip(F.coalesce(expected, F.lit("")))
    return strip(F.regexp_replace(bare, r"""(?s)\A(?:"(.*)"|'(.*)'|["'])\z""", "$1$2"))


def is_literal_list(text: Column) -> Column:
    """Whether unquoted text is a bracketed list of literals."""
    return text.startswith("[") & text.rlike(_LIST)


def literal_items(text: Column) -> Column:
    """Items of a bracketed list of literals.

    Each item, quotes taken off, is marked in one pass; escapes and numbers are
    then read and blanks at the ends dropped item by item.
    """
    body = F.substring(text, F.lit(2), F.length(text) - 2)
    marked = F.regexp_replace(body, _ITEM_CONTENT, f"{_MARK}$1$2{_BARE}$3")
    parts = F.split(marked, _MARK, -1)

    def item(part: Column) -> Column:
        quoted, bare = F.substring_index(part, _BARE, 1), F.substring_index(part, _BARE, -1)
        return strip(
            F.when(bare != "", F.when(bare.rlike(r"\d"), printed_number(bare)).otherwise(bare))
            .when(quoted.contains("\\"), unescaped(quoted))
            .otherwise(quoted)
        )

    return F.transform(F.slice(parts, 2, F.size(parts)), item)


def printed_number(text: Column) -> Column:
    """A number literal the way its value is printed."""
    word = F.lower(F.replace(text, F.lit("_"), F.lit("")))
    sign = F.when(word.startswith("-") & word.rlike("[1-9a-f]"), "-").otherwise("")
    bare = F.ltrim(word, F.lit("+-"))
    whole = [(r"\A0x", 16), (r"\A0o", 8), (r"\A0b", 2)]
    shown = F.when(bare.rlike(r"\A0+\z"), "0").when(bare.rlike(r"\A\d+\z"), bare)
    for prefix, base in whole:
        shown = shown.when(bare.rlike(prefix), F.conv(F.substring(bare, F.lit(3), F.length(bare)), base, 10))
    return F.concat(sign, shown.otherwise(printed_double(bare.try_cast("double"))))


def unescaped(text: Column) -> Column:
    """A string's content with its escapes read: those of JSON, and quotes, ``\\x`` and line joins."""
    json = F.regexp_replace(text, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    json = F.regexp_replace(json, r"(?s)\\(['\n])|(\\.)", r"$1$2")
    json = F.regexp_replace(json, "\n", r"\\n")
    json = F.regexp_replace(json, '(?<!\\\\)((?:\\\\\\\\)*)"', '$1\\\\"')
    read = F.get_json_object(F.concat(F.lit('["'), json, F.lit('"]')), "$[0]")
    return F.coalesce(read, F.regexp_replace(text, r"""\\(['"\\])""", "$1"))


# Tokens of a nested literal: strings, numbers, keywords, signs; white space falls between
# them, and any other character stands alone.
_TOKENS = rf"(?s){_STRING}|{_NUMBER}(?![\w.])|\b(?:None|True|False|null|true|false)\b|[^\s]"
_SIGNS = "[](){},:"
_CLOSERS = "])}"


def nested_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))


def _moves() -> dict[str, str]:
    """What a pushdown automaton does: from level, last step and kind of token to an action.

    Levels are ``.`` (outside), ``[``, ``(``, ``t`` (a tuple, once a comma is seen),
    ``{`` (undecided), ``s`` (a set), ``k`` and ``d`` (a dict before and after a colon). Last
    steps are ``o`` (opened), ``v`` (value), ``c`` (comma) and ``:``. An action is
    ``+`` (push), ``-`` (pop) or ``=`` (replace the level), the new level, the step and
    a mark: ``s`` for the comma of a tuple of one, ``b`` for a bracket around one value.
    """
    moves = {}
    ends = {"]": "[", ")": "(t", "}": "{skd"}
    after_comma = {"[": "[", "(": "t", "t": "t", "{": "s", "s": "s", "d": "k", ".": "."}
    for level in ".[(t{skd":
        for last in "oc:":
            moves |= {level + last + opened: f"+{opened}o." for opened in "[({"}
            moves[level + last + "v"] = f"={level}v."
        if level in after_comma:
            moves[level + "v,"] = f"={after_comma[level]}c{'s' if level == '(' else '.'}"
        if level in "{k":
            moves[level + "v:"] = "=d:."
        for closer, levels in ends.items():
            if level in levels:
                steps = ("v" if level != "k" else "") + ("o" if level in "[({" else "") + ("c" if level in "[tsk" else "")
                for last in steps:
                    moves[level + last + closer] = f"-.v{'b' if level + last == '(v' else '.'}"
    return moves


def nested_structure(tokens: Column) -> Column:
    """Whether tokens are a literal, and a mark for each: a fold with a stack of what is open.

    Marks are ``t`` for commas outside all brackets, ``i`` for those inside the
    first one, ``s`` and ``b`` as above; ``bare`` holds the places, from 1, of
    brackets around one value that are no tuple. Lists, dicts and sets can't be keys or
    members of sets.
    """
    table = F.create_map(*(F.lit(x) for pair in _moves().items() for x in pair))
    kinds = F.transform(
        tokens, lambda t: F.when(F.length(t) > 1, "v").when(t.isin(*_SIGNS), t).when(t.rlike(r"\d"), "v").otherwise("x")
    )

    def step(state: Column, kind: Column) -> Column:
        stack, at = state["stack"], state["at"] + 1
        hidden = kind.isin("[", "{") & stack.rlike("[{sk]")
        key = F.concat(F.right(stack, F.lit(1)), state["last"], F.when(hidden, "x").otherwise(kind))

        def move(code: Column) -> Column:
            action, mark = F.left(code, F.lit(1)), F.right(code, F.lit(1))
            below = F.left(stack, F.length(stack) - 1)
            depth = F.length(stack)
            opened, top = state["opened"], F.size(state["opened"])
            place = F.when(mark != ".", mark).when((kind != ",") | (depth > 2), ".").when(depth == 2, "i").otherwise("t")
            return F.struct(
                F.when(action == "+", F.concat(stack, kind)).when(action == "-", below)
                .otherwise(F.concat(below, F.substring(code, 2, 1))).alias("stack"),
                F.coalesce(F.substring(code, 3, 1), F.lit("x")).alias("last"),
                at.alias("at"),
                F.when(action == "+", F.concat(opened, F.array(at))).when(action == "-", F.slice(opened, 1, top - 1))
                .otherwise(opened).alias("opened"),
                F.when(mark == "b", F.concat(state["bare"], F.array(F.get(opened, top - 1), at)))
                .otherwise(state["bare"]).alias("bare"),
                F.concat(state["marks"], F.coalesce(place, F.lit("."))).alias("marks"),
            )

        # the action is looked up once a token, and after an error nothing is found any more
        return F.get(F.transform(F.array(F.try_element_at(table, key)), move), F.lit(0))

    none = F.array().cast("array<int>")
    begin = F.struct(
        F.lit(".").alias("stack"), F.lit("o").alias("last"), F.lit(0).alias("at"), none.alias("opened"),
        none.alias("bare"), F.lit("").alias("marks"),
    )
    return F.aggregate(kinds, begin, step, lambda s: F.struct(
        ((s["stack"] == ".") & (s["last"] == "v")).alias("ok"), s["bare"].alias("bare"),
        F.split(s["marks"], "").alias("marks"),
    ))


def printed_string(content: Column) -> Column:
    """A text the way a printed container shows it: quoted, with escapes."""
    plain = F.replace(content, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(char), F.lit(shown))

    def shown_char(char: Column) -> Column:
        code = F.lower(F.hex(F.ascii(char)))
        size = F.length(code)
        escape = (
            F.when(size <= 2, F.concat(F.lit("\\x"), F.lpad(code, 2, "0")))
            .when(size <= 4, F.concat(F.lit("\\u"), F.lpad(code, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(code, 8, "0")))
        )
        return F.when(char.rlike(r"[\p{C}\p{Z}&&[^ ]]"), escape).otherwise(char)

    hidden = plain.rlike(r"[\p{C}\p{Z}&&[^ ]]")
    safe = F.when(hidden, F.array_join(F.transform(F.split(plain, ""), shown_char), "")).otherwise(plain)
    double = safe.contains("'") & ~safe.contains('"')
    single = F.concat(F.lit("'"), F.replace(safe, F.lit("'"), F.lit("\\'")), F.lit("'"))
    shown = F.when(double, F.concat(F.lit('"'), safe, F.lit('"'))).otherwise(single)
    return F.when(content.rlike(r"\A[\w ,;:.-]*+\z"), F.concat(F.lit("'"), content, F.lit("'"))).otherwise(shown)


def nested_items(tokens: Column, found: Column) -> Column:
    """Items of a nested literal as they are printed: containers whole, strings among the items bare."""
    def content(token: Column) -> Column:
        inner = F.substring(token, F.lit(2), F.length(token) - 2)
        return F.when(inner.contains("\\"), unescaped(inner)).otherwise(inner)

    def printed(token: Column, place: Column) -> Column:
        at, following = place + 1, F.get(tokens, place + 1)
        words = F.create_map(*(F.lit(w) for w in ("null", "None", "true", "True", "false", "False")))
        return (
            F.when(F.array_contains(found["bare"], at), "")
            .when(token == ",", F.when(~following.isin(*_CLOSERS), ", ").when(F.get(found["marks"], place) == "s", ",").otherwise(""))
            .when(token == ":", ": ")
            .when(token.rlike(r"\A['\"]"), printed_string(content(token)))
            .when(token.isin(*"[](){}") | token.rlike(r"\A[1-9]\d{0,17}+\z"), token)
            .when(token.rlike(r"\d"), printed_number(token))
            .otherwise(F.coalesce(F.try_element_at(words, token), token))
        )

    wide = F.array_contains(found["marks"], "t")
    shown = F.transform(tokens, printed)
    places = F.transform(found["marks"], lambda m, i: F.when(m == F.when(wide, "t").otherwise("i"), i + 1))
    cuts = F.filter(places, lambda p: p.isNotNull())
    first = F.when(wide, 0).otherwise(1)
    end = F.when(wide, F.size(tokens) + 1).otherwise(F.size(tokens))
    begins, ends = F.concat(F.array(first), cuts), F.concat(cuts, F.array(end))
    spans = F.filter(F.arrays_zip(begins.alias("begin"), ends.alias("end")), lambda s: s["end"] - s["begin"] > 1)

    def item(span: Column) -> Column:
        text = F.array_join(F.slice(shown, span["begin"] + 1, span["end"] - span["begin"] - 1), "")
        at = F.sequence(span["begin"] + 1, span["end"] - 1)
        kept = F.filter(at, lambda p: ~F.array_contains(found["bare"], p))
        only = F.get(tokens, F.get(kept, F.lit(0)) - 1)
        return strip(F.when((F.size(kept) == 1) & only.rlike(r"\A['\"]"), content(only)).otherwise(text))

    return F.transform(spans, item)


def comma_parts(text: Column) -> Column:
    """Parts between commas without the blanks and quotes around them."""
    outer = F.regexp_replace(text, r"""\A"*+'*+|'*+"*+\z""", "")
    return F.split(outer, rf"""'*+"*+{SPACE}*+,{SPACE}*+"*+'*+""", -1)


def with_items(rows: DataFrame, text: Column, is_list: str, items: str) -> DataFrame:
    """Add an expected answer's items and whether it is a list.

    A bracketed list of literals gives its items, nested ones as they are
    printed; otherwise two or more comma-separated parts, none of them empty, give a list; anything else is a
    single value held as the only item. Each step is a projection of its own:
    the next uses it more than once, and short generated methods get compiled.
    """
    e, literal, parts = F.col("_text"), F.col("_literal"), F.col("_parts")
    keyword = literal & e.rlike("null|true|false")
    nested, found = F.col("_nested"), F.col("_found_in")
    bracketed = ~literal & e.startswith("[") & e.endswith("]") & e.rlike(r"(?s)\A.[^\[({]*+[\[({]")
    return (
        rows.withColumn("_text", unquoted(text))
        .withColumns(
            {"_literal": is_literal_list(e), "_parts": F.when(e.contains(","), comma_parts(e))}
        )
        .withColumn("_nested", F.when(bracketed, nested_tokens(e)))
        .withColumn("_found_in", F.when(nested.isNotNull(), nested_structure(nested)))
        .withColumn("_nested", F.when(found["ok"], nested_items(nested, found)))
        .withColumns(
            {
                "_text": F.when(keyword, _printed_keywords(e)).otherwise(e),
                "_parts": F.when(~F.array_contains(parts, ""), parts),
            }
        )
        .withColumns(
            {
                is_list: literal | nested.isNotNull() | parts.isNotNull(),
                items: F.when(literal, literal_items(e)).otherwise(
                    F.coalesce(nested, parts, F.array(e))
                ),
            }
        )
        .drop("_text", "_literal", "_parts", "_nested", "_found_in")
    )


def numbers(text: Column) -> Column:
    """All standalone runs of digits, in order."""
    return F.regexp_extract_all(text, F.lit(NUMBER), 0)


def identifiers(text: Column) -> Column:
    """Numbers and identifiers, pattern by pattern, first occurrence kept."""
    whole = [NUMBER, CASE_ID, LETTER_NUMBER, WORD_UNDERSCORE_NUMBER]
    found = [F.regexp_extract_all(text, F.lit(p), 0) for p in whole]
    found.append(F.regexp_extract_all(text, F.lit(WORD_NUMBER), 1))
    return F.array_distinct(F.concat(*found))


def identifier_set(text: Column) -> Column:
    """The same identifiers in two scans, for tests where order is irrelevant."""
    return F.array_distinct(
        F.concat(
            F.regexp_extract_all(text, F.lit(_WHOLE_IDENTIFIER), 0),
            F.regexp_extract_all(text, F.lit(WORD_NUMBER), 1),
        )
    )
