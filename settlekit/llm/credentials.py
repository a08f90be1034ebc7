"""Secret scan with multipart credential linking, in DataFrame functions only.

Each kind of part is found by one regular expression over the whole text; its
place is the running length of what lies between and inside the matches. Strong
kinds (``assign``, ``access``, ``hex``) are always reported. Weak ones are
common in clean text and are reported only if a part of another role (access
identifier, secret, endpoint) starts within ``SCOPE`` code points.

That interval join never forms pairs: parts are reduced to the first and the
last start for each text, role and bin of ``SCOPE`` code points, and a weak part
looks at the three bins around it. Only spans travel, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points between the starts of parts that belong together.
SCOPE = 300

VALUE = r"[A-Za-z0-9+/_.=-]"
#: kind, role, strong, pattern; the order of the kinds is the order of spans with one start.
KINDS: list[tuple[str, str, bool, str]] = [
    ("assign", "secret", True, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(""" + VALUE + "+)"),
    ("access", "identifier", True, r"AKIA[A-Z0-9]{12,}"),
    ("hex", "secret", True, r"[0-9a-f]{32,}"),
    ("short", "secret", False, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(""" + VALUE + "+)"),
    ("blob", "secret", False, r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}"),
    ("client", "identifier", False, r"""(?i)(client|account|access)[_-]?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.-]{6,}"""),
    ("endpoint", "endpoint", False, r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9_./%-]*)?"),
]
NUMBER = {kind: i for i, (kind, *_) in enumerate(KINDS)}
#: Characters of an assigned value that make it strong; shorter ones of at least SHORT are weak.
STRONG, SHORT = 8, 4


def _hits(kind: str, pattern: str) -> Column:
    """The matches of a kind as (kind, at, gap, size): the code points before the match since the last one, and in it.

    Matches of the assignment pattern split into ``assign`` and ``short`` by their value; those of neither count
    in the running length only (kind -1).
    """
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    number = F.lit(NUMBER[kind])
    match = lambda m: number
    if kind == "assign":
        value = lambda m: F.length(F.regexp_extract(m, pattern, 2))
        match = lambda m: F.when(value(m) >= STRONG, number).when(value(m) >= SHORT, F.lit(NUMBER["short"])).otherwise(F.lit(-1))
    if kind == "blob":
        match = lambda m: F.when(m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]"), number).otherwise(F.lit(-1))
    zipped = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(
        match(m).alias("kind"), F.lit(NUMBER[kind]).alias("run"), F.length(g).alias("gap"), F.length(m).alias("size")))
    return F.when(F.size(found) > 0, F.transform(zipped, lambda x, i: F.struct(x["kind"].alias("kind"), x["run"].alias("run"), i.alias("at"), x["gap"].alias("gap"), x["size"].alias("size"))))


def parts(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, end of every part in every text, and a row with null kind for each text.

    ``row`` tells repeated rows apart. Written to the checkpoint folder.
    """
    empty = F.array().cast("array<struct<kind:int,run:int,at:int,gap:int,size:int>>")
    hits = [F.coalesce(_hits(kind, pattern), empty) for kind, _, _, pattern in KINDS if kind != "short"]
    none = F.array(F.struct(*(F.lit(None).cast("int").alias(c) for c in ("kind", "run", "at", "gap", "size"))))
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select("row", "doc_id", F.concat(none, *hits).alias("hits"))
            .select("row", "doc_id", F.explode("hits").alias("hit")).select("row", "doc_id", "hit.*"))
    upto = Window.partitionBy("row", "run").orderBy("at")
    return (rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
            .filter(F.col("kind").isNull() | (F.col("kind") >= 0))
            .select("row", "doc_id", "kind", (F.col("end") - F.col("size")).alias("start"), "end").checkpoint())


def link(found: DataFrame) -> DataFrame:
    """The weak parts with a part of another role within ``SCOPE`` code points, from start to start."""
    role = F.element_at(F.array(*(F.lit(r) for _, r, _, _ in KINDS)), F.col("kind") + 1)
    weak = F.col("kind").isin([NUMBER[k] for k, _, strong, _ in KINDS if not strong])
    placed = found.filter("kind IS NOT NULL").withColumn("role", role).withColumn("bin", F.floor(F.col("start") / SCOPE))
    bins = (placed.groupBy("row", "role", "bin").agg(F.min("start").alias("first"), F.max("start").alias("last"))
            .select("row", F.col("role").alias("other"), "first", "last",
                    F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin")))
    near = (F.abs(placed["start"] - bins["first"]) <= SCOPE) | (F.abs(placed["start"] - bins["last"]) <= SCOPE)
    return placed.filter(weak).join(bins, (placed["row"] == bins["row"]) & (placed["bin"] == bins["bin"]) & (placed["role"] != bins["other"]) & near,
                                    "left_semi").select(found.columns)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every whole text.

    ``base_sha256`` is of the strong spans, ``spans`` lists all: ``kind:start:end`` in code points, by start, then
    kind, comma-joined. A weak part may overlap a strong one. A null or empty text has no spans. One row per input
    row, repeated ones and null ids included; an empty table gives none. Only doc_id and text are read.
    """
    found = parts(docs)
    strong = F.col("kind").isNull() | F.col("kind").isin([NUMBER[k] for k, _, s, _ in KINDS if s])
    count = lambda kind: F.count(F.when(F.col("kind") == NUMBER[kind], 1))
    spans = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    names = F.array(*(F.lit(k) for k, *_ in KINDS))
    written = lambda a: F.concat_ws(",", F.transform(F.array_sort(a), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))
    is_base = lambda s: s["kind"] <= NUMBER["hex"]
    return (found.filter(strong).unionByName(link(found)).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                 F.collect_list(spans).alias("found"))
            .select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(written(F.filter("found", is_base)), 256).alias("base_sha256"),
                    written(F.col("found")).alias("spans"), F.size(F.filter("found", lambda s: ~is_base(s))).alias("n_linked")))


def oracle() -> str:
    """The query of ``scan`` for DuckDB, whose expressions need no look-behind (a run's first match starts at its start)."""
    texts, branches = "SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents", []
    for kind, _, _, pattern in KINDS:
        if kind == "short":
            continue
        p = pattern.replace("(?<![A-Za-z0-9+/_-])", "").replace("'", "''")
        if p.startswith("(?i)"):  # letters of the word list in either case, ASCII only
            words, rest = p[4:].split(")", 1)
            p = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words) + ")" + rest.replace("id[", "[Ii][Dd][", 1)
        number = NUMBER[kind]
        case = f"{number}"
        if kind == "assign":
            value = f"length(regexp_extract(m, '{p}', 2))"
            case = f"CASE WHEN {value} >= {STRONG} THEN {number} WHEN {value} >= {SHORT} THEN {NUMBER['short']} ELSE -1 END"
        if kind == "blob":
            case = f"CASE WHEN regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]') THEN {number} ELSE -1 END"
        branches.append(f"""
            SELECT r, {case} AS kind, "end" - length(m) AS start, "end" FROM (
              SELECT r, m, sum(length(m) + length(g)) OVER (PARTITION BY r ORDER BY i) AS "end" FROM (
                SELECT r, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(len(ms))) AS i FROM (
                  SELECT r, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS gs FROM texts)))""")
    roles = "CASE " + " ".join(f"WHEN kind = {i} THEN '{r}'" for i, (_, r, _, _) in enumerate(KINDS)) + " END"
    names = "CASE " + " ".join(f"WHEN kind = {i} THEN '{k}'" for i, (k, *_) in enumerate(KINDS)) + " END"
    listed = f"coalesce(string_agg({names} || ':' || start || ':' || \"end\", ',' ORDER BY start, kind, \"end\")"
    return f"""
        WITH texts AS MATERIALIZED ({texts}),
        found AS MATERIALIZED (SELECT *, {roles} AS role FROM ({' UNION ALL '.join(branches)}) WHERE kind >= 0),
        told AS (SELECT * FROM found f WHERE kind <= {NUMBER['hex']} OR EXISTS (
          SELECT 1 FROM found o WHERE o.r = f.r AND o.role <> f.role AND abs(o.start - f.start) <= {SCOPE}))
        SELECT any_value(t.doc_id) AS doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex, sha256({listed} FILTER (kind <= {NUMBER['hex']}), '')) AS base_sha256,
               {listed} FILTER (kind IS NOT NULL), '') AS spans, (count(*) FILTER (kind > {NUMBER['hex']}))::INTEGER AS n_linked
        FROM texts t LEFT JOIN told USING (r) GROUP BY r
    """
