"""Column layouts of stored tables and reports, as DDL."""

BRONZE_TRANSACTIONS = (
    "transaction_id string, user_id string, merchant_id string, amount double, currency string, "
    "timestamp timestamp, channel string, card_type string, device_type string, ip_address string, "
    "country string, distance_from_home_km double, is_fraud int, fraud_type string"
)

AUDIT_RECORD = (
    "batch_id string, timestamp string, transaction_count bigint, users_count bigint, "
    "merchants_count bigint, fraud_count bigint, content_checksum string, tx_path string, status string"
)

PUBLICATION = (
    "number bigint, entries bigint, version string, published_at string, name string, path string, row_count bigint"
)

STAGE = "input_key string, stage string, run_id string, done_at string, result string"

DRIFT_REPORT = (
    "overall_status string, reference_sample_size bigint, current_sample_size bigint, "
    "drifting_features_count bigint, drifting_features array<string>, "
    "feature_metrics map<string,struct<ks_statistic:double,p_value:double,psi_score:double,"
    "wasserstein_distance:double,drift_detected:boolean,severity:string>>"
)

RUN_TELEMETRY = (
    "run_id string, started_at string, completed_at string, total_duration_seconds double, "
    "status string, error string, "
    "stages map<string,struct<duration_seconds:double,status:string,counts:map<string,bigint>>>"
)

TRAINING_RUN = (
    "run_id string, finished_at string, params map<string,string>, train_samples bigint, "
    "test_samples bigint, fraud_ratio_train double, metrics map<string,double>, "
    "top_features array<string>, model_path string"
)
