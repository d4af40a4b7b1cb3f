"""Record types of the claim-evidence tables, as DDL."""

from __future__ import annotations

PASSAGE = "struct<text:string,passage_source:string,locator:string,verification_status:string,verification_source:string,verified_at:string,supports_claim_atoms:array<string>>"
CONTEXT = f"struct<cite_key:string,doi:string,role:string,source_type:string,bibliography_status:string,integrity_status:string,integrity_checked_at:string,integrity_check_source:string,passages:array<{PASSAGE}>,direction_match:boolean,supports_claim_atoms:array<string>,independence_group:string,independence_basis:string,scope_match:string,notes:string>"
COMPONENT = "struct<score:int,rule_id:string,rationale:string>"
COMPONENTS = ["traceability", "robustness", "uncertainty_calibration", "source_integrity", "transferability_scope_control"]
TRUST = f"struct<rubric_version:string,components:struct<{','.join(f'{c}:{COMPONENT}' for c in COMPONENTS)}>,raw_score:int,overall_score:int,trust_label:string,capped:boolean,cap_value:int,cap_reasons:array<string>,computed_from:string,cap_reason:string>"
CLAIM = f"""claim_id string, section_id string, source_file string, paragraph_index int, sentence_index int, claim_text string, normalized_claim string,
claim_atoms array<struct<atom_id:string,text:string>>, claim_type string, scope_status string, modality string, wording_strength string,
citation_keys array<string>, dois array<string>, citation_contexts array<{CONTEXT}>, evidence_relation string,
conflicts array<struct<conflict_type:string,target_id:string,notes:string>>, trust_score {TRUST}, human_review_required boolean, validation_status string"""
EDGE = "source_claim_id string, relation string, target string, target_type string, weight double, notes string"
BIBLIOGRAPHY = "cite_key string, doi string, authors array<string>"
DIRECTIVE = "file string, ord int, options map<string,string>"
RADAR_CLAIM = "claim_id string, cited_dois array<string>, topic_queries array<string>"
RADAR_RECORD = "record_id string, alert_type string, doi string, title string, abstract string, topics array<string>, related_dois array<string>, published_at string, observed_at string, source struct<provider:string,url:string>"
PROPOSAL = "proposal_id string, source_type string, theme string, title string, priority string, affected_claim_ids array<string>, target_files array<string>, scientific_approval_required boolean"
SNAPSHOT_CLAIM = f"claim_id string, supersedes_claim_ids array<string>, claim_text string, citation_keys array<string>, evidence_basis string, trust struct<rubric_version:string,report_sha256:string,component_scores:struct<{','.join(f'{c}:int' for c in COMPONENTS)}>,overall_score:int,trust_label:string>, human_decision_references array<string>, relations array<struct<predicate:string,target_claim_id:string>>"
ANCHOR = "anchor_id string, selector struct<kind:string,claim_id:string,source_path:string,source_sha256:string,exact_quote:string,prefix:string,suffix:string>, human_decision_references array<string>"
SUBMISSION = """submission_id string, revision int, created_at string, target struct<review_id:string,review_version:string,release_manifest_sha256:string,selector:struct<kind:string,claim_id:string,source_path:string,source_sha256:string,exact_quote:string,prefix:string,suffix:string>>,
submitter struct<identity_ref:string,display_name:string,visibility:string>, content struct<kind:string,title:string,body_markdown:string,stance:string>, moderation struct<state:string,events:array<struct<event:string,at:string,actor_ref:string,supersedes_revision:int>>>, received_at string"""
