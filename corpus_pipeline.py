"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
"""

from gaugeloom.llm.crossparse import language_stage
from gaugeloom.llm.common import keep, load
from gaugeloom.llm.jaccard import near_duplicate_stage
from gaugeloom.llm.linechunks import line_stage
from gaugeloom.llm.packing import packing_stage
from gaugeloom.llm.templates import decontamination_stage

STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Language identification has no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
