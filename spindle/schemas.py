"""Schemas of the records between stages."""

from __future__ import annotations

COMMITS = "commit string, old_contents string, new_contents string, message string"
ONESHOT = "code_before string, instruct_descriptive string, instruct_lazy string"
PROMPTS_EXTEND = "commit array<string>, system string, user array<string>, code_snippet array<string>, commit_message array<string>"
PROMPTS_REWRITE = "commit string, system string, user string, old_code string, new_code string, commit_message string"
RESPONSES = "commit string, code_snippet array<string>, response_1 string, response_2 string, response array<string>, sample_index int"
SEPARATED = "commit string, code_snippet array<string>, code_before string, code_after string, instruct_descriptive string, instruct_lazy string"
TRIPLETS = SEPARATED + ", code_before_purify string, code_after_purify string, instruct_descriptive_purify string, instruct_lazy_purify string"
MIXED = "commit string, code_snippet array<string>, code_before_purify string, code_after_purify string, instruct_purify string, instr_type string"
ALPACA = "instruction string, system string, output string, commit string, instr_type string, old_code string, new_code string"
SHAREGPT = "messages array<struct<role:string,content:string>>, commit string, instr_type string, old_code string, new_code string"
DIFF = "added int, removed int, modified int, hunk_num int, diff_hunk_num int"
