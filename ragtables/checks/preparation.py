"""Checked queries: columns, layouts, prompts, sampling, splits, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.checks.base import (
    SQL_PASSAGES,
    SQL_QA,
    SQL_TITLED,
    check,
    passages,
    qa,
    sql_hash,
    sql_normalize,
    table,
    titled,
)
from ragtables.functions import templates
from ragtables.functions.text import normalize_text, tokenize
from ragtables.operators import columns, normalizers, prompts, sampling
from ragtables.plans.prepare import Step, run_steps
from ragtables.sources.tables import balanced


def _joined(name: str) -> F.Column:
    return F.array_join(columns.quoted(name), " | ").alias(name.replace("-", "_"))


@check(
    """SELECT doc_id, text, lang, text AS content, text AS body,
              'fixed' AS kind, 'documents' AS origin
       FROM documents"""
)
def select_tag_update(spark: SparkSession, folder: str) -> DataFrame:
    df = columns.select_columns(
        table(spark, folder, "documents"), ["doc_id", "text", "lang"]
    )
    df = columns.update_columns(df, {"text": "content", "content": "body"})
    return columns.tag(columns.set_field(df, "kind", "fixed"), "documents", "origin")


@check(
    f"""WITH {SQL_PASSAGES}
        SELECT doc_id, array_to_string(passages, ', ') AS flat,
               array_to_string(passages[1:3], chr(10)) AS passages
        FROM passages"""
)
def flatten_join_docs(spark: SparkSession, folder: str) -> DataFrame:
    df = columns.flatten_list(passages(spark, folder), "passages", "flat")
    df = columns.join_documents(df, "passages", 3)
    return df.select("doc_id", "flat", "passages")


@check(
    f"""WITH {SQL_TITLED}
        SELECT doc_id, coalesce(title, 'None') || ': ' || content AS doc FROM titled"""
)
def context_titles(spark: SparkSession, folder: str) -> DataFrame:
    docs = titled(spark, folder).select(
        "doc_id", F.array(F.struct("content", "title")).alias("docs")
    )
    docs = columns.title_documents(docs, "docs")
    return docs.select("doc_id", F.explode("docs").alias("doc"))


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, query, answer || ' | ' || query AS answers,
               answer || ' | ' || query AS answer_long,
               {sql_normalize("answer")} || ' / ' || {sql_normalize("query")}
                 || ' | ' || {sql_normalize("query")} AS answer_short
        FROM qa"""
)
def normalize_asqa(spark: SparkSession, folder: str) -> DataFrame:
    raw = qa(spark, folder).select(
        "row_id",
        F.col("query").alias("ambiguous_question"),
        F.array(
            F.struct(F.col("answer").alias("long_answer")),
            F.struct(F.col("query").alias("long_answer")),
        ).alias("annotations"),
        F.array(
            F.struct(F.array("answer", "query").alias("short_answers")),
            F.struct(F.array("query").alias("short_answers")),
        ).alias("qa_pairs"),
    )
    df = normalizers.normalize_asqa(raw)
    groups = F.transform("`answer-short`", lambda g: F.array_join(g, " / "))
    return df.select(
        "row_id",
        "query",
        _joined("answers"),
        _joined("answer-long"),
        F.array_join(groups, " | ").alias("answer_short"),
    )


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, query, answer AS answers,
               'None: ' || replace(answer, chr(10), '')
                 || ' | ' || query || ': ' || replace(query, ' ', '') AS passages
        FROM qa"""
)
def normalize_hotpot(spark: SparkSession, folder: str) -> DataFrame:
    # Three paragraphs for two titles: the third one has no partner.
    context = F.struct(
        F.array(F.lit(None).cast("string"), F.col("query")).alias("title"),
        F.array(
            F.split("answer", "\n"), F.split("query", " "), F.array("answer")
        ).alias("sentences"),
    )
    raw = qa(spark, folder).select(
        "row_id", F.col("query").alias("question"), "answer", context.alias("context")
    )
    df = normalizers.normalize_hotpot(raw)
    return df.select(
        "row_id",
        "query",
        _joined("answers"),
        F.array_join("positive_passages", " | ").alias("passages"),
    )


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, query, answer || ' | ' || query AS options,
               CASE WHEN turn > 1 THEN 'B' ELSE 'A' END AS answers
        FROM qa"""
)
def normalize_arc(spark: SparkSession, folder: str) -> DataFrame:
    raw = qa(spark, folder).select(
        "row_id",
        F.col("query").alias("question"),
        F.struct(F.array("answer", "query").alias("text")).alias("choices"),
        F.when(F.col("turn") > 1, "B").otherwise("A").alias("answerKey"),
    )
    df = normalizers.normalize_arc(raw)
    return df.select("row_id", "query", _joined("options"), "answers")


@check(
    f"""WITH {SQL_PASSAGES}
        SELECT p.doc_id, p.source AS query,
               CASE WHEN l.toxic = 1 THEN 'maybe' WHEN l.quality = 1 THEN 'yes'
                    ELSE 'no' END AS answers,
               array_to_string(p.passages, ' | ') AS passages
        FROM passages p JOIN labels l ON l.doc_id = p.doc_id"""
)
def normalize_pubmed(spark: SparkSession, folder: str) -> DataFrame:
    decision = (
        F.when(F.col("toxic") == 1, "maybe")
        .when(F.col("quality") == 1, "yes")
        .otherwise("no")
    )
    raw = (
        passages(spark, folder)
        .join(table(spark, folder, "labels"), "doc_id")
        .select(
            "doc_id",
            F.col("source").alias("QUESTION"),
            decision.alias("final_decision"),
            F.col("passages").alias("CONTEXTS"),
        )
    )
    df = normalizers.normalize_pubmed(raw)
    return df.select(
        "doc_id",
        "query",
        _joined("answers"),
        F.array_join("positive_passages", " | ").alias("passages"),
    )


@check("SELECT doc_id, quality, toxic FROM labels WHERE quality = 1 OR toxic = 1")
def filter_selected(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "labels").withColumn(
        "passages", F.struct(F.array("quality", "toxic").alias("is_selected"))
    )
    return columns.filter_rows(raw, "MSMARCO").select("doc_id", "quality", "toxic")


@check("SELECT doc_id, lang, n_chars FROM documents WHERE lang <> 'en' AND n_chars > 400")
def filter_registered(spark: SparkSession, folder: str) -> DataFrame:
    """A predicate of the user's own, by its registered name."""
    if "long_foreign" not in columns.FILTERS:
        columns.register_filter(
            "long_foreign", lambda: (F.col("lang") != "en") & (F.col("n_chars") > 400)
        )
    docs = columns.filter_rows(table(spark, folder, "documents"), "long_foreign")
    return docs.select("doc_id", "lang", "n_chars")


@check(
    f"""SELECT doc_id, {sql_normalize("text")} AS normalized,
               array_to_string(list_transform(
                 regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}]+|[^\\p{{Z}}\\p{{C}}]'),
                 lambda t: lower(t)), ' ') AS tokens
        FROM documents"""
)
def normalize_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    return balanced(table(spark, folder, "documents")).select(
        "doc_id",
        normalize_text("text").alias("normalized"),
        F.array_join(tokenize("text"), " ").alias("tokens"),
    )


# ----------------------------------------------------------------- row numbers


@check(
    f"""SELECT doc_id,
               row_number() OVER (ORDER BY {sql_hash(3, "doc_id")}, doc_id) - 1 AS shuffled,
               row_number() OVER (ORDER BY doc_id) - 1 AS ordered,
               row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR)) - 1 AS by_text
        FROM documents"""
)
def row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    df = sampling.row_index(docs, "doc_id", 3, output="shuffled")
    df = sampling.row_index(df, "doc_id", order="key", output="ordered")
    df = df.withColumn("name", F.col("doc_id").cast("string"))
    return sampling.row_index(df, "name", order="key", output="by_text").drop("name")


@check(
    f"""SELECT doc_id, lang, n_chars FROM documents
        ORDER BY {sql_hash(42, "doc_id")}, doc_id LIMIT 100"""
)
def shuffle_limit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return sampling.shuffle_select(docs, "doc_id", 42, 100)


@check(
    f"""(SELECT 'shuffled' AS kind, CAST(doc_id AS VARCHAR) AS name, n_chars FROM documents
         ORDER BY {sql_hash(42, "doc_id")}, doc_id LIMIT 900)
        UNION ALL
        (SELECT 'by number', CAST(doc_id AS VARCHAR), n_chars FROM documents
         ORDER BY doc_id LIMIT 350)
        UNION ALL
        (SELECT 'by name', CAST(doc_id AS VARCHAR), n_chars FROM documents
         ORDER BY CAST(doc_id AS VARCHAR) LIMIT 350)"""
)
def shuffle_limit_large(spark: SparkSession, folder: str) -> DataFrame:
    """Large limits: of a shuffle, and without a seed of a number and a text key."""
    docs = table(spark, folder, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("name"), "n_chars"
    )
    cases = [("shuffled", "doc_id", 42, 900), ("by number", "doc_id", None, 350)]
    cases.append(("by name", "name", None, 350))
    parts = [
        sampling.shuffle_select(docs, key, seed, limit).select(
            F.lit(kind).alias("kind"), "name", "n_chars"
        )
        for kind, key, seed, limit in cases
    ]
    return parts[0].union(parts[1]).union(parts[2])


@check(
    f"""WITH {SQL_QA}, ranked AS (
          SELECT row_id, row_number() OVER (ORDER BY {sql_hash(5, "row_id")}, row_id) AS r,
                 count(*) OVER () AS n,
                 {sql_hash(6, "row_id")} / 1152921504606846976.0 AS u
          FROM qa)
        SELECT row_id, CASE WHEN r <= ceil(n * 0.1) THEN 'dev' ELSE 'train' END AS split,
               CASE WHEN u < 0.1 THEN 'dev' ELSE 'train' END AS drawn
        FROM ranked"""
)
def train_dev_split(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.split_column(qa(spark, folder).select("row_id"), "row_id", 0.1, 5)
    return sampling.split_column(df, "row_id", 0.1, 6, exact=False, output="drawn")


# -------------------------------------------------------------------- sampling


def _sql_draws(table_: str, key: str, k: int, seed: int) -> str:
    """SQL for ``k`` distinct rows other than the row itself: ``_key, _pos, _id_key``."""
    tops = [f"(m - {k - i})" for i in range(k)]
    raw = ", ".join(
        f"{sql_hash(seed, f'''k || ':' || CAST({top} AS VARCHAR)''')} % ({top} + 1) AS t{i}"
        for i, top in enumerate(tops)
    )
    picked, ids = [], []
    for i, top in enumerate(tops):
        if i:
            picked.append(
                f"CASE WHEN t{i} IN ({', '.join(ids)}) THEN {top} ELSE t{i} END AS i{i}"
            )
        else:
            picked.append("t0 AS i0")
        ids.append(f"i{i}")
    return f"""idx AS (
      SELECT {key} AS k, row_number() OVER (ORDER BY {sql_hash(seed, key)}, {key}) - 1 AS idx,
             count(*) OVER () - 1 AS m FROM {table_}),
    raw AS (SELECT k, idx, m, {raw} FROM idx),
    floyd AS (SELECT k, idx, {", ".join(picked)} FROM raw),
    ids AS (SELECT k, idx, unnest([{", ".join(ids)}]) AS id FROM floyd),
    shifted AS (SELECT k, CASE WHEN id >= idx THEN id + 1 ELSE id END AS id FROM ids),
    draws AS (
      SELECT s.k AS _key, i.k AS _id_key, row_number() OVER (PARTITION BY s.k
             ORDER BY {sql_hash(seed + 1, "s.k || ':' || CAST(s.id AS VARCHAR)")}) - 1 AS _pos
      FROM shifted s JOIN idx i ON i.idx = s.id)"""


@check(
    f"""WITH {SQL_PASSAGES}, {_sql_draws("passages", "doc_id", 1, 11)}
        SELECT p.doc_id, array_to_string(o.passages, ' | ') AS negatives
        FROM passages p JOIN draws d ON d._key = p.doc_id
        JOIN passages o ON o.doc_id = d._id_key"""
)
def sample_negatives(spark: SparkSession, folder: str) -> DataFrame:
    docs = passages(spark, folder)
    df = sampling.sample_rows(
        docs, 1, "doc_id", 11, "negative_passages", input_key="passages"
    )
    return df.select(
        "doc_id", F.array_join("negative_passages", " | ").alias("negatives")
    )


@check(
    f"""WITH {SQL_PASSAGES}, {_sql_draws("passages", "doc_id", 2, 12)},
        both_ AS (
          SELECT d._key, array_to_string(flatten(list(o.passages ORDER BY d._pos)), ' | ') AS t
          FROM draws d JOIN passages o ON o.doc_id = d._id_key GROUP BY d._key)
        SELECT p.doc_id, b.t AS negatives FROM passages p JOIN both_ b ON b._key = p.doc_id"""
)
def sample_two_flattened(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.sample_rows(
        passages(spark, folder), 2, "doc_id", 12, "n", "passages", flatten=True
    )
    return df.select("doc_id", F.array_join("n", " | ").alias("negatives"))


@check(
    f"""WITH {SQL_QA}, idx AS (
          SELECT item_id, row_number() OVER (ORDER BY {sql_hash(13, "item_id")}, item_id) - 1
                 AS idx, count(*) OVER () AS n FROM benchmark),
        size AS (SELECT DISTINCT n FROM idx)
        SELECT q.row_id, b.text AS passage
        FROM (SELECT row_id, {sql_hash(13, "row_id || ':' || CAST(n - 1 AS VARCHAR)")} % n AS id
              FROM qa, size) q
        JOIN idx i ON i.idx = q.id JOIN benchmark b ON b.item_id = i.item_id"""
)
def sample_other_table(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.sample_rows(
        qa(spark, folder).select("row_id"),
        1,
        "row_id",
        13,
        "passage",
        input_key="text",
        source=table(spark, folder, "benchmark"),
        source_key="item_id",
    )
    return df.select("row_id", "passage")


@check(
    f"""WITH {SQL_PASSAGES}, {_sql_draws("passages", "doc_id", 1, 21)}
        SELECT p.doc_id, CASE WHEN {sql_hash(22, "p.doc_id")} / 1152921504606846976.0 > 0.4
                 THEN array_to_string(list_concat(p.passages[1:2], o.passages[1:3]), ' | ')
                 ELSE array_to_string(o.passages[1:3], ' | ') END AS docs
        FROM passages p JOIN draws d ON d._key = p.doc_id
        JOIN passages o ON o.doc_id = d._id_key"""
)
def raft_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = columns.update_columns(
        passages(spark, folder), {"passages": "positive_passages"}
    )
    docs = sampling.sample_rows(
        docs, 1, "doc_id", 21, "negative_passages", input_key="positive_passages"
    )
    df = sampling.mix_distractors(docs, "doc_id", 22, k=2, raft_p=0.4, neg_docs_num=3)
    return df.select("doc_id", _joined("docs"))


@check(
    """SELECT 'documents' AS source, doc_id, text FROM documents
       UNION ALL SELECT 'benchmark' AS source, item_id AS doc_id, text FROM benchmark"""
)
def merge_tagged(spark: SparkSession, folder: str) -> DataFrame:
    frames = {
        "documents": table(spark, folder, "documents").select("doc_id", "text"),
        "benchmark": table(spark, folder, "benchmark").select(
            F.col("item_id").alias("doc_id"), "text"
        ),
    }
    return sampling.merge_tables(frames, seed=9, key="doc_id", keyword="source")


# --------------------------------------------------------------------- prompts


def _sql_template(template: str, **fields: str) -> str:
    """SQL for a filled template, by plain text replacement of its literals."""
    text = "'" + template.replace("'", "''") + "'"
    for name, expression in fields.items():
        text = text.replace("{" + name + "}", f"' || {expression} || '")
    return text


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, {_sql_template(templates.QA, context="answer", question="query")}
                 AS prompt,
               {_sql_template("{{turn}} {turn}: {missing}", missing="''", turn="turn")
                 .replace("{' || turn || '}", "{turn}")} AS header
        FROM qa"""
)
def prompt_qa(spark: SparkSession, folder: str) -> DataFrame:
    df = prompts.text_prompt(
        qa(spark, folder),
        templates.QA,
        {"question": "query", "context": "answer", "answer": "unused"},
    )
    df = prompts.text_prompt(
        df, "{{turn}} {turn}: {missing}", {"turn": "turn", "missing": "nowhere"}, "header"
    )
    return df.select("row_id", "prompt", "header")


@check(
    f"""WITH {SQL_QA}, {_sql_draws("qa", "row_id", 3, 7)},
        shown AS (
          SELECT d._key, d._pos,
                 {_sql_template(templates.QA_WITH_ANSWER, context="'None'", question="o.query",
                                answer="o.answer")} AS t
          FROM draws d JOIN qa o ON o.row_id = d._id_key),
        blocks AS (
          SELECT _key, string_agg(t, chr(10) || chr(10) ORDER BY _pos) AS fewshot
          FROM shown GROUP BY _key)
        SELECT q.row_id,
               {_sql_template(templates.QA_FEWSHOT, fewshot="b.fewshot", context="'None'",
                              question="q.query")} AS prompt
        FROM qa q JOIN blocks b ON b._key = q.row_id"""
)
def prompt_fewshot(spark: SparkSession, folder: str) -> DataFrame:
    rows = qa(spark, folder).withColumn("context", F.lit(None).cast("string"))
    mapping = {"question": "query", "context": "context", "answer": "answer"}
    df = sampling.few_shot(rows, 3, "row_id", 7, columns=["query", "context", "answer"])
    df = prompts.fewshot_prompt(
        df, templates.QA_WITH_ANSWER, "fewshot", mapping, "fewshot"
    )
    df = prompts.text_prompt(
        df, templates.QA_FEWSHOT, {**mapping, "fewshot": "fewshot"}
    )
    return df.select("row_id", "prompt")


_INSTRUCTIONS = (
    templates.INSTRUCTION_QA,
    templates.INSTRUCTION_QA_SHORT,
    templates.INSTRUCTION_YES_NO,
    templates.INSTRUCTION_YES_NO_MAYBE,
)


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, {_sql_template(templates.COT, context="answer", question="query")} AS cot,
               {_sql_template(templates.COT_FEWSHOT, fewshot="query", context="answer",
                              question="query")} AS cot_fewshot,
               {_sql_template(templates.FACT_STATEMENT, i="turn", content="answer")} AS fact,
               {_sql_template(templates.REASON_BEFORE_ANSWER, reasoning="answer")} AS reasoned
        FROM qa"""
)
def prompt_reasoning(spark: SparkSession, folder: str) -> DataFrame:
    """The layouts that ask for reasoning, with or without examples, and state facts."""
    df = qa(spark, folder)
    fields = {
        "question": "query", "context": "answer", "fewshot": "query",
        "content": "answer", "i": "turn", "reasoning": "answer",
    }
    layouts = {
        "cot": templates.COT,
        "cot_fewshot": templates.COT_FEWSHOT,
        "fact": templates.FACT_STATEMENT,
        "reasoned": templates.REASON_BEFORE_ANSWER,
    }
    for name, template in layouts.items():
        df = prompts.text_prompt(df, template, fields, name)
    return df.select("row_id", *layouts)


@check(
    f"""WITH {SQL_QA}, said AS (
          SELECT unnest(range({len(_INSTRUCTIONS)})) AS kind,
                 unnest({[*_INSTRUCTIONS]!r}) AS instruction)
        SELECT row_id, CAST(kind AS INTEGER) AS kind, CAST(p AS INTEGER) AS position,
               (['system', 'user'])[p + 1] AS role,
               ([instruction, instruction || chr(10) || query])[p + 1] AS content
        FROM qa, said, range(2) AS positions(p)"""
)
def instruction_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every question under each of the instructions that are provided."""
    rows = qa(spark, folder)
    for kind, instruction in enumerate(_INSTRUCTIONS):
        rows = prompts.inference_messages(rows, "query", instruction, True, f"under_{kind}")
    each = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(f"under_{kind}").alias("messages"))
        for kind in range(len(_INSTRUCTIONS))
    ])
    flat = rows.select("row_id", F.explode(each).alias("asked"))
    flat = flat.select("row_id", "asked.kind", F.posexplode("asked.messages").alias("position", "m"))
    return flat.select("row_id", "kind", "position", "m.role", "m.content")


def _turns(df: DataFrame) -> DataFrame:
    return df.select("row_id", F.posexplode("messages").alias("position", "m")).select(
        "row_id", "position", "m.role", "m.content"
    )


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, CAST(p AS INTEGER) AS position,
               (['system', 'user', 'assistant'])[p + 1] AS role,
               (['Be brief.', 'Be brief.' || chr(10) || query, answer])[p + 1] AS content
        FROM qa, range(3) AS positions(p)"""
)
def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = qa(spark, folder).withColumn("answers", F.array("answer"))
    return _turns(
        prompts.training_messages(rows, "query", "answers", "Be brief.", True)
    )


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, CAST(p AS INTEGER) AS position, (['system', 'user'])[p + 1] AS role,
               (['Be brief.', query])[p + 1] AS content
        FROM qa, range(2) AS positions(p)"""
)
def inference_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _turns(prompts.inference_messages(qa(spark, folder), "query", "Be brief."))


@check(
    f"""WITH {SQL_QA}
        SELECT row_id, 'Q: ' || query || chr(10) || 'A: ' || answer AS text,
               'Be brief. Q: ' || query AS asked
        FROM qa"""
)
def template_texts(spark: SparkSession, folder: str) -> DataFrame:
    df = prompts.training_text(
        qa(spark, folder), "Q: {query}\nA: {output}", "query", "answer"
    )
    df = prompts.inference_text(
        df, "{instruction} Q: {query}", "Be brief.", "query", "asked"
    )
    return df.select("row_id", "text", "asked")


# ------------------------------------------------------------------- whole run


@check(
    f"""WITH {SQL_QA}, rows_ AS (
          SELECT 'qa' AS source, row_id, query, answer FROM qa
          UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), text, NULL FROM benchmark)
        SELECT source, row_id, 'Question: ' || query AS prompt, 'run' AS stage FROM rows_"""
)
def steps_over_tables(spark: SparkSession, folder: str) -> DataFrame:
    """One step on several named tables, then a merge into a third one."""
    frames = {
        "qa": qa(spark, folder).select("row_id", "query", "answer"),
        "benchmark": table(spark, folder, "benchmark").select(
            F.col("item_id").cast("string").alias("row_id"), F.col("text").alias("query")
        ),
    }
    both = ["qa", "benchmark"]
    steps = [
        Step(columns.set_field, both, {"key": "stage", "value": "run"}),
        Step(
            prompts.text_prompt,
            both,
            {"template": templates.QA_SHORT, "mapping": {"query": "query"}},
        ),
        Step(
            lambda tables: {
                "merged": sampling.merge_tables(
                    {n: tables[n] for n in both}, keyword="source"
                )
            },
            both,
            whole=True,
            outputs=["merged"],
            keep=False,
        ),
    ]
    merged = run_steps(frames, steps)["merged"]
    return merged.select("source", "row_id", "prompt", "stage")
