"""Prompt templates by version. Only placeholders and section marks are a contract."""

from __future__ import annotations

SYSTEM = "You write small, realistic code edits for a training set. Answer in the sections that you are asked for and add nothing else."

EXTEND_ROUND_1 = """Two snippets from real programs:

{code_snippet_1}

{code_snippet_2}

Take them as inspiration for one self-contained program that could be edited. Then ask for an edit of it twice: once in full
and once as a short request. Example of such requests for the program

{code_before_shot}

[Descriptive]
{desc_instr_shot}

[Lazy]
{lazy_instr_shot}

Answer with the sections [Program Before Edit], [Descriptive] and [Lazy]. If no sensible edit exists, answer <UNREASONABLE>."""

EXTEND_ROUND_2 = """Now make the edit. Answer with the section [Program After Edit], which holds the whole program."""

REWRITE = """A commit changes this program:

{old_code}

by this diff:

{diff}

Its message is: {commit_message}

Say what the edit asks for, in full and as a short request, like this:

[Descriptive]
{desc_instr_shot}

[Lazy]
{lazy_instr_shot}"""


def get_prompts(version: str) -> tuple[str, list[str]]:
    """System prompt and the prompts of each round: ``v5.1`` extends snippets in two rounds, ``v5.9`` rewrites commits."""
    rounds = {"v5.1": [EXTEND_ROUND_1, EXTEND_ROUND_2], "v5.9": [REWRITE]}
    if version not in rounds:
        raise ValueError(f"unsupported prompt version {version!r}")
    return SYSTEM, rounds[version]
