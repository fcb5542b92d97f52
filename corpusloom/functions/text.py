"""Text expressions: tokenizer, language window, character trigrams, headers.

Each ``*_sql`` function returns a Spark SQL expression, so one definition
serves both DataFrames (``F.expr``) and ML pipelines (``SQLTransformer``). All
of them are built-in expressions evaluated inside the row: a document is
tokenised, counted and normed where it is read, without a shuffle.
"""

from pyspark.sql import Column, functions as F

from corpusloom.functions.fixed_values import (
    MIN_TOKEN_CHARS,
    STOP_WORDS,
    WINDOW_APPLIES_ABOVE,
    WINDOW_CHARS,
    WINDOW_SKIP,
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(words) -> str:
    """Words as a comma-separated list of Spark SQL string literals."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def raw_tokens_sql(text: str) -> str:
    """Lower-case runs of ASCII letters, dots and hyphens, long enough to keep.

    Same tokens as blanking every other character, lower-casing and splitting
    on blanks, in one pass over the text. Only ASCII letters are lowered,
    because some non-ASCII capitals lower to ASCII letters.
    """
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), "
        f"'[-.a-z]{{{MIN_TOKEN_CHARS},}}', 0)"
    )


def tokens_sql(text: str) -> str:
    """Tokens of ``text`` without stop words."""
    return f"filter({raw_tokens_sql(text)}, t -> t NOT IN ({quoted(STOP_WORDS)}))"


def token_runs_sql(tokens: str) -> str:
    """Array of (term, c): how often each term occurs in an array of tokens.

    Sorts the array and measures its runs. The one-element arrays bind the
    sorted tokens and the run starts to lambda variables, so that neither is
    evaluated again for every element.
    """
    return (
        f"transform(array(sort_array({tokens})), s -> "
        "transform(array(filter(if(size(s) = 0, array(), sequence(0, size(s) - 1)), "
        "i -> i = 0 OR get(s, i) <> get(s, i - 1))), b -> "
        "transform(b, (p, j) -> named_struct('term', get(s, p), "
        "'c', CAST(coalesce(get(b, j + 1), size(s)) - p AS BIGINT))))[0])[0]"
    )


def runs_norm_sql(runs: str) -> str:
    return f"sqrt(aggregate({runs}, 0D, (a, r) -> a + CAST(r.c AS DOUBLE) * r.c))"


def norm_sql(tokens: str) -> str:
    """Euclidean norm of all term counts of an array of tokens."""
    return runs_norm_sql(token_runs_sql(tokens))


def language_window_sql(text: str) -> str:
    """Part of a document that its language is judged by."""
    return (
        f"CASE WHEN length({text}) > {WINDOW_APPLIES_ABOVE} "
        f"THEN substring({text}, {WINDOW_SKIP + 1}, {WINDOW_CHARS}) ELSE {text} END"
    )


def trigrams_sql(text: str) -> str:
    """All overlapping three-character substrings, line breaks included."""
    return f"regexp_extract_all(coalesce({text}, ''), '(?s)(?=(...)).', 1)"


def tokens(text: str = "text") -> Column:
    return F.expr(tokens_sql(text))


def token_runs(tokens: str = "tokens") -> Column:
    return F.expr(token_runs_sql(tokens))


def runs_norm(runs: str = "runs") -> Column:
    return F.expr(runs_norm_sql(runs))


def language_window(text: str = "text") -> Column:
    return F.expr(language_window_sql(text))


def header_field(headers: Column, name: str) -> Column:
    """Value of one header line, blank-trimmed; empty when there is none."""
    return F.trim(F.regexp_replace(F.regexp_extract(headers, f"(?mi)^{name}:([^\\n]*)", 1), "[\\r\\t]", " "))


def content_type(headers: Column) -> Column:
    """Normalised content type of a header block."""
    return F.lower(header_field(headers, "Content-Type"))


def decode_array_text(value: Column) -> Column:
    """``{a,b}`` as an array; for importing result tables stored as text."""
    return F.split(F.translate(value, "{}", ""), ",")
