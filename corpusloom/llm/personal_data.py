"""Personal data in texts by weak supervision, in Spark SQL functions only.

Candidates are the matches of a wide pattern per kind; the strict ones
(``base``) are always personal data. Labelers look at each candidate and vote
that it is, that it is not, or not at all:

* ``format``    the strict pattern and its check digits or ranges hold
* ``shape``     length and separators are usual for the kind
* ``gazetteer`` a known mail domain, card prefix, area code or reserved range
* ``context``   a word before it that announces the kind
* ``against``   what stands directly around it speaks of a number or a name of something else

Expectation-maximisation over the counts of vote patterns, of which there are
at most 3^5 a kind, estimates each labeler's reliability and the probability
of each pattern, with no labels given. A logistic span classifier is then
trained on these probabilities, over votes and features of the span, and
decides on candidates that are not strict. Counts cover the whole corpus;
only pattern counts reach the driver, and their number does not grow.

Places are code points, ends exclusive. A null or empty text has no spans.
Matches, their places and votes are worked out inside a document's row, so
equal or null keys need no care and no text is shuffled. Texts with any
number of matches take time in proportion to their length.
"""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import kept

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("format", "shape", "gazetteer", "context", "against")
FEATURES = 4

#: The strict patterns.
STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches without a second look at the inside of a run of letters or digits, which
#: cannot begin a match if the run's start (or the place after the last match) did not. Groups
#: at the end repeat without backtracking, so that long runs need no deep stack.
RUNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": STRICT["phone"],
}
#: Wider ones, for candidates beside the strict matches.
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]+)++",
    "ip": r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}",
    "card": r"[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}",
    "phone": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}
#: Words that announce a kind.
CONTEXT = {
    "email": "e-?mails?|mail|contact|write|address",
    "ip": "ips?|hosts?|servers?|addresses|address|clients?|logins?",
    "card": "cards?|visa|mastercard|amex|credit|debit|account|iban|payments?",
    "phone": "phones?|tel|telephone|calls?|fax|mobile|cell|contact",
}
#: Public mail domains, card prefixes, reserved areas.
GAZETTEER = {
    "email": r"(?i)(gmail|yahoo|hotmail|outlook|aol|icloud|gmx|web|proton(mail)?)\.[a-z.]+$|\.(com|org|net|edu|gov|info|de|fr|es|uk)$",
    "ip": r"^(?!0\.|127\.|255\.)[0-9]{1,3}\.",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^(\+[1-9]|\(?[2-9][0-9]{2})",
}
SHAPE = {
    "email": r"^[^@(\[]{1,64}.{4,190}$",
    "ip": r"^(([0-9]{1,3}\.){3}[0-9]{1,3}|[0-9A-Fa-f:]{15,39})$",
    "card": r"^([0-9]{13,19}|[0-9]{4}([\x20-][0-9]{4}){2}[\x20-][0-9]{1,7})$",
    "phone": r"^[+(0-9][\x20().0-9-]{8,18}[0-9]$",
}
AGAINST_BEFORE = r"(?i)[=#$_/\\.:,-]$|[A-Za-z0-9]$|\b(version|v|id|isbn|no|order|sha|build|section|page)[\s.:#]{0,2}$"
AGAINST_AFTER = r"^[A-Za-z0-9_=/\\%]"
AROUND = 32
BLOCK = 64
ITERATIONS = 40
ACCEPT = 0.9

SPAN = "kind: string, start: int, end: int, value: string, base: boolean"


def _places(matches: str, gaps: str) -> str:
    """SQL: structs of start and value of the matches of a pattern, from the pieces of the text between them.

    Lengths are summed in blocks, so many matches do not take their square.
    """
    sized = f"transform(sequence(1, size({matches})), i -> struct(char_length({gaps}[i - 1]) AS g, {matches}[i - 1] AS v))"
    blocks = f"transform(sequence(0, (size(p) - 1) DIV {BLOCK}), b -> slice(p, b * {BLOCK} + 1, {BLOCK}))"
    total = "aggregate(b, 0, (a, x) -> a + x.g + char_length(x.v))"
    inner = f"aggregate(slice(b, 1, j), 0, (a, x) -> a + x.g + char_length(x.v)) + x.g"
    return (
        f"IF(size({matches}) = 0, CAST(array() AS array<struct<start: int, value: string>>), "
        f"element_at(transform(array({sized}), p -> element_at(transform(array({blocks}), bs -> "
        f"element_at(transform(array(transform(bs, b -> {total})), ts -> flatten(transform(bs, (b, k) -> "
        f"element_at(transform(array(aggregate(slice(ts, 1, k), 0, (a, t) -> a + t)), o -> "
        f"transform(b, (x, j) -> named_struct('start', o + {inner}, 'value', x.v))), 1)))), 1)), 1)), 1))"
    )


def _text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(value: str) -> str:
    """SQL: whether the digits of a value pass Luhn's check."""
    digits = f"reverse(regexp_replace({value}, '[^0-9]', ''))"
    chars = f"transform(sequence(1, char_length(d)), i -> (CAST(substring(d, i, 1) AS INT) * (1 + (i + 1) % 2)))"
    total = "aggregate(" + chars + ", 0, (a, x) -> a + CAST(x DIV 10 AS INT) + x % 10)"
    return f"element_at(transform(array({digits}), d -> {total} % 10 = 0), 1)"


def strict_check(kind: str, value: str = "m.value") -> str:
    """SQL: the check that a strict match must pass."""
    count = f"char_length(regexp_replace({value}, '[^0-9]', ''))"
    if kind == "email":
        return "true"
    if kind == "ip":
        part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return f"{value} RLIKE {_text('^' + part + '([.]' + part + '){3}$')}"
    if kind == "card":
        return f"IF({count} BETWEEN 14 AND 19, {_luhn(value)}, false)"
    return f"{count} BETWEEN 10 AND 15"


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans) of every row: strict matches and further candidates, by start and then kind."""
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "coalesce(CAST(text AS STRING), '') AS text")
    for kind in KINDS:
        for name, pattern in (("strict", RUNS[kind]), ("wide", WIDE[kind])):
            p = _text(pattern)
            rows = rows.selectExpr("*", f"regexp_extract_all(text, {p}, 0) AS {kind}_{name}")
    for kind in KINDS:
        for name, pattern in (("strict", RUNS[kind]), ("wide", WIDE[kind])):
            p = _text(pattern)
            gaps = f"IF(size({kind}_{name}) = 0, CAST(array() AS array<string>), split(text, {p}, -1))"
            rows = rows.withColumn(f"{kind}_{name}_gaps", F.expr(gaps))
    for kind in KINDS:
        for name in ("strict", "wide"):
            rows = rows.withColumn(f"{kind}_{name}_at", F.expr(_places(f"{kind}_{name}", f"{kind}_{name}_gaps")))
    own = []
    for i, kind in enumerate(KINDS):
        struct = "named_struct('start', m.start, 'k', {i}, 'kind', '{kind}', 'end', m.start + char_length(m.value), 'value', m.value, 'base', {base})"
        strict = f"transform({kind}_strict_at, m -> {struct.format(i=i, kind=kind, base=strict_check(kind))})"
        wide = f"transform({kind}_wide_at, m -> {struct.format(i=i, kind=kind, base='false')})"
        own += [strict, wide]
    rows = rows.selectExpr("doc_id", "text", f"concat({', '.join(own)}) AS every")
    rows = rows.selectExpr("doc_id", "text", "array_sort(every) AS every")
    # left out: failed strict matches found twice, and candidates that touch a strict span near them in order
    near = f"slice(every, greatest(1, i + 1 - {BLOCK}), {2 * BLOCK})"
    free = f"NOT exists({near}, b -> b.base AND b.start < s.end AND s.start < b.end)"
    loose = f"char_length(s.value) BETWEEN 7 AND 200 AND (i = 0 OR every[greatest(i, 1) - 1] != s) AND {free}"
    return rows.selectExpr("doc_id", "text", f"filter(every, (s, i) -> s.base OR ({loose})) AS spans")


def _vote(yes: str, no: str) -> str:
    return f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END"


def voted(rows: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: each span with its votes and features."""
    by_kind = lambda table: "CASE s.kind " + " ".join(f"WHEN '{k}' THEN {_text(table[k])}" for k in KINDS) + " END"
    before = f"substring(text, greatest(1, s.start + 1 - {AROUND}), least(s.start, {AROUND}))"
    after = "substring(text, s.end + 1, 8)"
    announced = {k: rf"(?i)\b({CONTEXT[k]})\W{{0,12}}(\w+\W+)?$" for k in KINDS}
    other = {k: r"(?i)\b(" + "|".join(CONTEXT[o] for o in KINDS if o != k) + r")\W{0,4}$" for k in KINDS}
    context = f"s.b RLIKE ({by_kind(announced)})"
    votes = ", ".join(
        [
            _vote("s.base", "true"),
            _vote(f"s.value RLIKE ({by_kind(SHAPE)})", "true"),
            _vote(f"s.value RLIKE ({by_kind(GAZETTEER)})", "false"),
            _vote(context, f"s.b RLIKE ({by_kind(other)})"),
            _vote("false", f"s.b RLIKE {_text(AGAINST_BEFORE)} OR s.a RLIKE {_text(AGAINST_AFTER)}"),
        ]
    )
    digits = "char_length(regexp_replace(s.value, '[^0-9]', ''))"
    features = (
        f"array(least({digits}, 20) DIV 4, least(char_length(s.value), 40) DIV 8, "
        "IF(s.value RLIKE '[\\\\x20.()-]', 1, 0), IF(s.b RLIKE '\\\\s$' OR s.b = '', 1, 0))"
    )
    around = f"transform(spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'value', s.value, 'base', s.base, 'b', {before}, 'a', {after}))"
    shown = f"transform(around, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'base', s.base, 'votes', array({votes}), 'features', {features}))"
    return rows.selectExpr("doc_id", f"{around} AS around").selectExpr("doc_id", f"{shown} AS spans")


def pattern_counts(spans: DataFrame) -> DataFrame:
    """(kind, votes, features, n) over the corpus."""
    each = spans.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    return each.groupBy("kind", "votes", "features").agg(F.count("*").alias("n"))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability that a candidate with these votes is personal data, by expectation-maximisation.

    Labelers are taken as independent given the truth; each has a rate for each
    of its votes under either truth. Starts from the balance of votes.
    """
    total = sum(n for _, n in patterns)
    if not total:
        return {}
    belief = {votes: 1 / (1 + 2.718281828 ** (-1.5 * sum(votes))) for votes, _ in patterns}
    for _ in range(ITERATIONS):
        true = sum(n * belief[v] for v, n in patterns)
        share = (true + 1) / (total + 2)
        rates = []
        for k in range(len(LABELERS)):
            own = {}
            for vote in (-1, 0, 1):
                yes = sum(n * belief[v] for v, n in patterns if v[k] == vote)
                no = sum(n * (1 - belief[v]) for v, n in patterns if v[k] == vote)
                own[vote] = ((yes + 0.5) / (true + 1.5), (no + 0.5) / (total - true + 1.5))
            rates.append(own)
        for votes, _ in patterns:
            yes, no = share, 1 - share
            for own, vote in zip(rates, votes):
                yes, no = yes * own[vote][0], no * own[vote][1]
            belief[votes] = yes / (yes + no)
    return belief


def classifier(spans: DataFrame) -> dict[str, tuple[list[float], float]]:
    """Weights and bias of each kind's span classifier, trained on the estimated probabilities."""
    spark = spans.sparkSession
    rows = pattern_counts(spans).collect()  # votes and features have a few values each
    out = {}
    for kind in KINDS:
        own = [r for r in rows if r.kind == kind]
        counts: dict[tuple, int] = {}
        for r in own:
            counts[tuple(r.votes)] = counts.get(tuple(r.votes), 0) + r.n
        belief = reliabilities(sorted(counts.items()))
        data = []
        for r in own:
            p = belief[tuple(r.votes)]
            x = [float(v) for v in (*r.votes, *r.features)]
            data += [(x, 1.0, r.n * p), (x, 0.0, r.n * (1 - p))]
        data = [row for row in data if row[2] > 0]
        if len({label for _, label, _ in data}) < 2:
            out[kind] = ([0.0] * (len(LABELERS) + FEATURES), 0.0)
            continue
        frame = spark.createDataFrame(sorted(data), "x array<double>, label double, weight double").coalesce(1)
        frame = frame.select(array_to_vector("x").alias("features"), "label", "weight")
        model = LogisticRegression(weightCol="weight", maxIter=30, regParam=0.001).fit(frame)
        out[kind] = (model.coefficients.toArray().tolist(), float(model.intercept))
    return out


def _probability(model: dict[str, tuple[list[float], float]]) -> str:
    """SQL: the classifier's probability for a span s."""
    cases = []
    for kind, (weights, bias) in model.items():
        parts = [f"{w!r}D * s.votes[{i}]" for i, w in enumerate(weights[: len(LABELERS)])]
        parts += [f"{w!r}D * s.features[{i}]" for i, w in enumerate(weights[len(LABELERS) :])]
        cases.append(f"WHEN '{kind}' THEN 1 / (1 + exp(-({bias!r}D + {' + '.join(parts)})))")
    return f"CASE s.kind {' '.join(cases)} END"


def detected(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: strict spans and those the classifier accepts, with its probability."""
    spans = kept(voted(found(docs)), "spans")
    model = classifier(spans)
    sure = f"filter(transform(spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'base', s.base, 'p', {_probability(model)})), s -> s.base OR s.p >= {ACCEPT})"
    return spans.selectExpr("doc_id", f"{sure} AS spans")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the strict spans, all spans, and how many were added."""
    listed = "array_join(transform({0}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.base)"
    counts = [f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS]
    return detected(docs).selectExpr(
        "doc_id", *counts, f"sha2({listed.format(base)}, 256) AS base_sha256", f"{listed.format('spans')} AS spans",
        "CAST(size(filter(spans, s -> NOT s.base)) AS BIGINT) AS n_added",
    )
