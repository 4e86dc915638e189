"""Explicit schemas of the tables."""

from __future__ import annotations

DOCUMENTS = "id string not null, url string not null, title string, summary string, content_hash string not null, content_length bigint, domain string not null, source_phase string, source_dump string, detected_content_type string, quality_score double, quality_components map<string,double>, quality_profile_used string, wilson_score double, importance_score double, cluster_id int, novelty_distance double, farthest_point_rank bigint, status string, merged_into string, raw_html_hash string, created_at timestamp"
DOCUMENT_TEXTS = "doc_id string not null, text string not null"
GOLDEN_SET = "url string not null, label string, content_type string, notes string, raw_metrics map<string,double>, version int, domain string"
COVERAGE = "topic_gini double, domain_gini double, orphan_rate double, high_quality_orphans bigint, cluster_count bigint, largest_cluster_pct double"
JOBS = "id string not null, dump_name string, dump_path string, status string, total_urls bigint, filtered_urls bigint"
MAPPINGS = "doc_id string, x double, y double, z double, cluster_id int, quality_score double, url string, title string, domain string, content_type string, excerpt string"
DUMP = "url string, html string, text string, metadata map<string,string>, domain string"
