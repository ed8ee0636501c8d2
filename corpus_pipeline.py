"""A corpus cleaning pipeline of five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the rows it keeps, all but the last with the columns of ``documents``. A doc_id
names one document.
"""

from __future__ import annotations

from overlace.llm.common import met, stored, table
from overlace.llm.decontaminate import contamination
from overlace.llm.exactdup import table_duplicates
from overlace.llm.neardup import near_duplicates
from overlace.llm.packing import pack
from overlace.llm.toxicity import keep_clean


def without(docs, dropped):
    """``docs`` but for the documents whose doc_id is in ``dropped``; null doc_ids stay."""
    return met(docs, stored(dropped.select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the model takes for toxic go.

    Null and empty texts are judged by the model's bias alone. Repeated rows are each
    judged, rows of a null doc_id too. Without labels of both classes nothing goes, or
    all if all labels are 1. Other columns, whatever their names, are carried along; an
    empty table stays empty.
    """
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark, docs, sf_dir):
    """Of equal texts the document with the largest doc_id stays.

    Null text counts as empty, so one of all documents without text stays. Repeated rows
    of one doc_id and text are one document and all stay or go; rows of a null doc_id stay.
    Other columns are carried along; an empty table stays empty.
    """
    return without(docs, table_duplicates(docs).where("not kept"))


def near_stage(spark, docs, sf_dir):
    """Of each group of near copies (similarity 0.8 or more) the document with the smallest doc_id stays.

    Null, empty and word-less texts are near nothing and stay, as do rows of a null doc_id.
    Repeated rows of one doc_id stay or go together. Other columns are carried along; an
    empty table stays empty.
    """
    return without(docs, near_duplicates(docs, percent=80).where("not kept"))


def benchmark_stage(spark, docs, sf_dir):
    """Documents contaminated by benchmark passages go.

    Null, empty and word-less texts are never contaminated. A doc_id goes if any row of it
    is contaminated; rows of a null doc_id stay. Other columns are carried along; empty
    tables give an empty result, or one without hits.
    """
    return without(docs, contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def packing_stage(spark, docs, sf_dir):
    """The pieces of all documents left, packed into sequences.

    Null text counts as empty: its end alone. Repeated rows are each packed, rows of a null
    doc_id too. Other columns don't matter; an empty table gives an empty result.
    """
    return pack(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("decontamination", benchmark_stage), ("packing", packing_stage)]

#: A trained model decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
