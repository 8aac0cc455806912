"""Column expressions over text: templates, pre-tokens and the response marker."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftframe.options import EOS_TOKEN

# The prompt formats that trained models expect, and the kinds of pieces that text is split into.
SYSTEM_TEXT = {
    "v1": "Below is an instruction that describes a task. Write a response that completes the request.\n\n",
    "v2": "Below is an instruction that describes a task. Write a response that completes the request. \n\n",
}
INSTRUCTION_MARKER = "###Instruction:\n"
RESPONSE_MARKER = "###Response:\n"
LETTERS, DIGITS, OTHER, SPACES = r" ?\p{L}+", r" ?\p{N}+", r"[^\s\p{L}\p{N}]", r"\s+"


def _required(col: Column, what: str) -> Column:
    return F.coalesce(col, F.raise_error(F.lit(f"{what} is null")))


def format_prompt(instruction: Column, template: str = "v1") -> Column:
    """Prompt of an evaluation: ends with an empty response marker, without EOS."""
    return F.concat(
        F.lit(SYSTEM_TEXT[template] + INSTRUCTION_MARKER),
        _required(instruction, "instruction"),
        F.lit("\n\n" + RESPONSE_MARKER),
    )


def format_full_text(instruction: Column, response: Column, template: str = "v2", eos: str = EOS_TOKEN) -> Column:
    """Training text: prompt, response and EOS.  A null instruction or response fails the job."""
    return F.concat(format_prompt(instruction, template), _required(response, "response"), F.lit(eos))


def pre_tokens(text: Column, eos: str = EOS_TOKEN) -> Column:
    """Split text into pieces whose concatenation is the text.

    EOS is always a piece of its own: the signs before it end where it begins.
    """
    eos_pattern = re.sub(r"([^\w\s<>])", r"\\\1", eos)
    signs = f" ?(?:(?!{eos_pattern}){OTHER})+"
    return F.regexp_extract_all(text, F.lit("|".join([eos_pattern, LETTERS, DIGITS, signs, SPACES])), F.lit(0))


def instruction_part(text: Column) -> Column:
    """The text up to the end of the first response marker; empty when there is none."""
    at = F.instr(text, F.lit(RESPONSE_MARKER))
    return F.when(at > 0, F.substr(text, F.lit(1), at + F.lit(len(RESPONSE_MARKER) - 1))).otherwise(F.lit(""))
