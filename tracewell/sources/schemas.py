"""Declared schemas: nothing is inferred on reading."""

from __future__ import annotations

CATALOG = "id string, downloads long, likes long, pipeline_tag string, created_at string, last_modified string, tags string, card_data string"
CARDS = "id string, modelcard string, year int, month int, pos long, github_links array<string>, arxiv_links array<string>, collection_arxiv_links array<string>, main_github string, main_github_confidence double, main_github_source string, main_arxiv string, main_arxiv_confidence double, main_arxiv_source string"
GROUND_TRUTH = "who string, id string, position string, method string, provider string, chip string, source_note string"
REPO_TREE = "owner string, repo string, path string, path_pos int"
REPO_FILE = "owner string, repo string, path string, content string"
PAPER_HTML = "arxiv_id string, html string"
PAPER_TEXT = "arxiv_id string, text string"
COLLECTION_ITEM = "owner string, slug string, owner_pos int, item_type string, item_id string"
ANSWERS = "id string, answer string, card_text string"
EMPTY_VERDICT = "id string, chip_provider string, chip_provider_score double, chip_provider_confidence double, chip_providers_all array<struct<vendor:string,score:double>>, chip_snippets array<struct<provider:string,snippet:string,source:string>>"
_PART = "chip_provider:string,chip_provider_confidence:double,chip_providers_all:map<string,double>"
_RESOLUTION = "struct<candidate_links:array<string>,selected_link:string,heuristic_confidence:double,source:string,llm_answer:string>"
RESULTS = (
    f"id string, year int, month int, modelcard_analysis struct<{_PART},matched_sections:array<string>>, github_resolution {_RESOLUTION}, github_code_analysis struct<{_PART},detection_files:array<string>>, "
    f"arxiv_resolution {_RESOLUTION}, arxiv_paper_analysis struct<{_PART},detection_sections:array<string>>, conclusion struct<chip_provider:string,chip_provider_source:string,chip_provider_confidence:double,expected_provider:string,correct:int>"
)
