"""The model prompt (M1) as a ``concat`` of fixed text and columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.text import col_

# --- fixed values -----------------------------------------------------------
# The system message and the user prompt sent for every window. {focus},
# {context} and {chunk} are filled per request; everything else is literal.
SYSTEM_PROMPT = (
    "You are a highly skilled analyst and insightful communicator specializing in "
    "extracting deep insights and explaining complex topics from articles in a clear, "
    "engaging, and well-structured HTML format. Your goal is not just to summarize, "
    "but to provide a comprehensive understanding that includes critical analysis and "
    "contextual explanations. Assume the reader is intelligent but may not be familiar "
    "with all specific jargon or background details mentioned in the text."
)
USER_PROMPT = (
    "Summarize the text delimited using the following identifier: ####\n"
    "Return the summary in HTML formatting.\n"
    "Have a section that states the exact name and date of this article (if discernible).\n"
    "Have a section for 1 to 2 sentence high-level executive summary.\n"
    "Have a section for keywords, and list horizontally the key concepts from the summary.\n"
    "Then, provide a 'Detailed Analysis and Contextual Summary' section. This section should be comprehensive and insightful. It must:\n"
    "  - Clearly articulate the article's main arguments, thesis, and key takeaways.\n"
    "  - Explain any crucial concepts, terminology, or jargon in simple, understandable terms, providing necessary context for a reader who may not be deeply familiar with the topic.\n"
    "  - Offer insightful analysis: What are the broader implications or significance of the article's points? How does this connect to other trends or relevant information? Are there any noteworthy nuances, underlying assumptions, or potential counter-arguments mentioned or implied in the text?\n"
    "  - Be well-structured and flow logically, not just a list of points. Subheadings within this section are encouraged for clarity if the analysis is extensive.\n"
    "This 'Detailed Analysis and Contextual Summary' section is the core of your output. {focus}\n"
    "If the following background context delimited by #### isn't empty, include this information in your overall analysis. It is not a separate section, just additional information.\n"
    "Background context: ####{context}####\n"
    "Original text for this chunk: ####{chunk}####"
)
DEFAULT_FOCUS = ""
SAMPLING = {"temperature": 0.7, "top_p": 1.0, "frequency_penalty": 0.0, "presence_penalty": 0.0}
# ---------------------------------------------------------------------------


def _segments() -> list[str]:
    """The template cut at its placeholders: text, name, text, name, ..."""
    out, rest = [], USER_PROMPT
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        out += [head, name]
    return out + [rest]


def prompt_text(focus: Column, context, chunk) -> Column:
    """The user prompt for one window, as one ``concat``. ``context`` and
    ``chunk`` are columns or column names; NULL fills as empty text."""
    vals = {"focus": focus, "context": col_(context), "chunk": col_(chunk)}
    parts = []
    for i, seg in enumerate(_segments()):
        parts.append(F.lit(seg) if i % 2 == 0
                     else F.coalesce(vals[seg], F.lit("")))
    return F.concat(*parts)


def prompt_py(focus: str, context: str, chunk: str) -> str:
    """The same prompt built in Python (for plug-in summarizers)."""
    return USER_PROMPT.format(focus=focus, context=context, chunk=chunk)


def sql_prompt(focus_sql: str, context_sql: str, chunk_sql: str) -> str:
    """The same prompt as a DuckDB expression."""
    vals = {"focus": focus_sql, "context": context_sql, "chunk": chunk_sql}
    parts = []
    for i, seg in enumerate(_segments()):
        if i % 2 == 0:
            parts.append("'" + seg.replace("'", "''") + "'")
        else:
            parts.append(f"coalesce({vals[seg]}, '')")
    return "(" + " || ".join(parts) + ")"
