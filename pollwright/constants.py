"""Values that must be equal in every run for results to agree."""

# --- fixed values -----------------------------------------------------------
TASKS = [
    "answer_lookup",
    "answer_reverse_lookup",
    "conceptual_aggregation",
    "multi_hop_relational_inference",
    "respondent_count",
    "rule_based_querying",
]
FORMATS = ["html", "json", "md", "ttl", "txt", "xml"]
RESULT_COLUMNS = [
    "case_id",
    "task",
    "question",
    "questionnaire",
    "expected_answer",
    "prompt",
    "Response",
    "Correct",
]
PROMPT_COLUMNS = RESULT_COLUMNS + ["skip"]

DATA_BLOCK = "[Insert the full data block here]"
QUESTIONNAIRE = "[questionnaire]"
QUESTION = "[question]"
EXAMPLE = "[CASE_1]"
EXAMPLE_MISSING = "[CASE_1 data not available]"

SECTIONS = ["example", "questionnaire", "role", "format", "request", "output", "task"]
REORDERED_SECTIONS = [
    "example", "role", "format", "request", "output", "task", "questionnaire",
]
VARIANTS = [
    "wo_change_order",
    "wo_format_explaination",
    "wo_oneshot",
    "wo_partition_mark",
    "wo_role_prompting",
]
APPROACHES = {
    "format_explaination": (
        "<approach>\n"
        "Generate short format specification and description of the survey"
        " within five sentences.\n"
        "</approach>"
    ),
    "critical_values": (
        "<approach>\n"
        "Identify critical values and ranges of the survey related"
        " within five sentences.\n"
        "</approach>"
    ),
    "structural_info": (
        "<approach>\n"
        "Describe structural information, patterns and statistics of the survey"
        " within five sentences.\n"
        "</approach>"
    ),
}
OUTPUT_FORMAT = (
    "\n<output_format>\n"
    "Structure your response:\n\n"
    "### ANALYSIS ###\n"
    "[Your analysis here]\n\n"
    "### ANSWER ###\n"
    "[Your final answer]\n\n"
    "### END ###\n"
    "</output_format>"
)
MAX_TOKENS = 4000
# ----------------------------------------------------------------------------
