"""Results as JSON records and as Markdown text, and the prompt for comparisons."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomograph.plans.paging import Page


def records(df: DataFrame) -> DataFrame:
    """Each row as a JSON record; absent fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def as_text(df: DataFrame, heading: str) -> DataFrame:
    """Each row as Markdown: the heading column, then a line for each other field that is present."""
    fields = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"- **{c}:** "), F.col(c).cast("string"))) for c in df.columns if c != heading]
    return df.select(F.concat_ws("\n", F.concat(F.lit("### "), F.coalesce(F.col(heading).cast("string"), F.lit("(untitled)"))), *fields).alias("text"))


def page_text(result: Page, heading: str) -> str:
    """A page as Markdown, with what it leaves out said at the end."""
    out = []
    for row in result.rows:
        fields = row.asDict()
        out.append("\n".join([f"### {fields.pop(heading) or '(untitled)'}", *(f"- **{k}:** {v}" for k, v in fields.items() if v is not None)]))
    if result.truncated:
        out.append(f"{result.shown} rows are shown, as many as the page holds ({result.cap}); there may be more.")
    return "\n\n".join(out)


def relations_text(rows: DataFrame) -> DataFrame:
    """rows: source_uri, ordinal, relation_type, direction, place, related_work_uri, related_celex_number, as relations of a page. For
    each source its relations as Markdown: a heading for each type and direction in the order of the request, outgoing
    first, and under it a line for each related work in the page's order."""
    item = F.concat(F.lit("- "), F.when(F.col("related_celex_number").isNull(), F.col("related_work_uri")).otherwise(F.concat("related_celex_number", F.lit(" ("), "related_work_uri", F.lit(")"))))
    lines = rows.groupBy("source_uri", "ordinal", "relation_type", "direction").agg(F.array_sort(F.collect_list(F.struct("place", item.alias("line")))).alias("lines"))
    heading = F.concat(F.lit("### "), "relation_type", F.lit(" ("), "direction", F.lit(")"))
    block = F.concat(heading, F.lit("\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
    blocks = lines.groupBy("source_uri").agg(F.array_sort(F.collect_list(F.struct("ordinal", (F.col("direction") == "incoming").alias("second"), block.alias("block")))).alias("blocks"))
    return blocks.select("source_uri", F.array_join(F.transform("blocks", lambda x: x["block"]), "\n\n").alias("text"))


# The axes of a comparison, and the words that lead a focus to an axis, tried in this order.
AXES = ("regulatory_scope", "core_obligations", "key_differences", "enforcement", "recent_developments", "practical_implications")
FOCUS_RULES = (
    ("enforcement", r"enforce|penalt|sanction|remed|liabilit|prosecut"),
    ("recent_developments", r"recent|latest|newest|\bdevelopment"),
    ("key_differences", r"difference|diverg|contrast|\bcompar|distinct"),
    ("regulatory_scope", r"\bscope|coverage|applicab|regulated entit|who is (?:covered|regulated)"),
    ("core_obligations", r"obligation|\bduty|\bduties|requirement|complian"),
    ("practical_implications", r"practical|implication|operational"),
)
QUESTIONS = {
    "regulatory_scope": "Which activities and which parties do the rules cover?",
    "core_obligations": "What must these parties do, and what must they not do?",
    "key_differences": "On which points do the two systems differ most?",
    "enforcement": "Which authorities enforce the rules, and with what penalties?",
    "recent_developments": "Which acts, rulings and guidance are new?",
    "practical_implications": "What follows for a party that is active in both jurisdictions?",
}


def focus_axis(focus: Column) -> Column:
    """The axis that a focus belongs to by the first rule that fits; null for a new angle."""
    chain = F.lit(None).cast("string")
    for axis, pattern in reversed(FOCUS_RULES):
        chain = F.when(F.lower(focus).rlike(pattern), axis).otherwise(chain)
    return chain


def comparison_prompt(domain: str, focus: str | None = None) -> str:
    """A request for a comparison of EU and US law. A focus takes its axis's place, or that of the differences if it is a new angle."""
    focus = (focus or "").strip()
    axis = next((a for a, p in FOCUS_RULES if re.search(p, focus.lower())), None) if focus else None
    steps = []
    for n, name in enumerate(AXES, 1):
        title, question = name.replace("_", " ").capitalize(), QUESTIONS[name]
        if focus and name == axis:
            title = focus[0].upper() + focus[1:]
        elif focus and axis is None and name == "key_differences":
            title, question = focus[0].upper() + focus[1:], "Look closely at this aspect."
        steps.append(f"{n}. **{title}**: {question}")
    return "\n".join(
        [
            f"Compare EU and US law on **{domain}**" + (f", with weight on **{focus}**." if focus else "."),
            "",
            f'For the EU, find concepts for "{domain}" in the thesaurus, search regulations and directives under them, read the most important ones and follow their relations.',
            f'For the US, search opinions on "{domain}" and add statutes and regulations where they matter.',
            "",
            "Then answer, citing CELEX numbers, cases and statutes:",
            *steps,
        ]
    )
