"""Record types of the curation tables and the constants that govern them."""

from __future__ import annotations

# Identifiers, tiers, limits and time spans.
SOURCE_ID = {"ieee": r"^\d{8}$", "arxiv": r"^arxiv:\d{4}\.\d{4,5}$"}
TIER = {"ieee": 1, "arxiv": 2}
UNKNOWN_TIER = 99
QUEUE_LIMIT, TTL_HOURS, TITLE_RATIO, PASS_SCORE = 5, 72, 93.0, 60.0
MAX_ATTEMPTS, BREAKER_FAILURES, NO_BATCH_HOURS, REALERT_HOURS = 5, 3, 36, 24
SPIKE_ENTRIES, SPIKE_RATIO, KEEP_DAYS = 5, 0.3, 90
FINAL_STATES = ("approved", "approved_local", "rejected")

SECTION = "struct<heading_raw:string,content:string,confidence:double>"
DOCUMENT = (
    "uid string, source string, source_id string, authority_tier int, alternate_uids array<string>, title string, title_normalized string, abstract string, "
    "authors array<string>, published_date timestamp, url string, full_text string, "
    f"sections struct<doc_type:string,context:{SECTION},method:{SECTION},findings:{SECTION},implications:{SECTION}>, "
    "tech_meta struct<has_code_repo:boolean,code_repo_url:string,dataset_specification:string,evaluated_benchmarks:array<string>,declared_limitations:string>, "
    "critique_questions array<struct<question:string,labels:array<string>>>, "
    "rubric struct<total:double,passed:boolean,breakdown:array<struct<key:string,weight:double,sub_score:double,reason:string>>>, "
    "status string, fetched_at timestamp, last_interaction_at timestamp, page_id string"
)
TABLES = {
    "dlq": "id bigint, uid string, error_type string, error_detail string, raw_path string, attempts int, retry_eligible boolean, created_at timestamp",
    "events": "id bigint, uid string, event_type string, detail string, created_at timestamp",
    "runs": "id bigint, query string, started_at timestamp, finished_at timestamp, report_json string",
    "alerts": "key string, state string, detail string, first_seen timestamp, last_notified timestamp",
    "screening": "id bigint, uid string, agent string, model string, verdict string, criterion_id string, evidence_quote string, confidence string, created_at timestamp",
    "extraction": "id bigint, uid string, field string, value string, quote string, section string, verified int, created_at timestamp",
}
