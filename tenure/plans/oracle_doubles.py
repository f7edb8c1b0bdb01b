"""Generated by tools/gen_oracle_types.py: double columns per oracle query."""

DOUBLE_COLUMNS = {
    'balance_oversample': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'baseline_first_row': ['active_license_count', 'business_category_1_urgent', 'business_category_2_high', 'business_category_3_medium', 'business_category_4_not_specified', 'business_category_5_low', 'complaint_type_click', 'complaint_type_error', 'complaint_type_purchase', 'complaint_type_signup', 'complaint_type_view', 'business_latitude', 'business_longitude'],
    'baseline_median_profile': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window'],
    'build_profiles': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window', 'location_cluster_lat_first12m_first', 'location_cluster_lng_first12m_first', 'business_category_unheard_first12m_max'],
    'business_activity_summary': ['complaint_sum'],
    'business_level_dataset': ['business_latitude', 'business_longitude'],
    'business_license_metadata': ['latitude', 'longitude'],
    'business_locations': ['business_latitude', 'business_longitude'],
    'clamp_bounds': ['business_latitude', 'business_longitude'],
    'class_metrics': ['accuracy', 'recall'],
    'clean_license_fields': ['latitude', 'longitude'],
    'clean_licenses': ['latitude', 'longitude'],
    'clean_service_requests': ['latitude', 'longitude'],
    'complaint_signal': ['complaint_value'],
    'cox_prepare_std': ['active_license_count', 'business_category_1_urgent', 'business_category_2_high', 'business_category_3_medium', 'business_category_4_not_specified', 'business_category_5_low', 'complaint_type_click', 'complaint_type_error', 'complaint_type_purchase', 'complaint_type_signup', 'complaint_type_view', 'business_latitude', 'business_longitude'],
    'cox_prepare_tv': ['active_license_count', 'business_category_1_urgent', 'business_category_2_high', 'business_category_3_medium', 'business_category_4_not_specified', 'business_category_5_low', 'complaint_type_click', 'complaint_type_error', 'complaint_type_purchase', 'complaint_type_signup', 'complaint_type_view', 'business_latitude', 'business_longitude'],
    'cox_risk_set_stats': ['s0', 's1_active_license_count', 's1_complaint_type_click', 's1_business_latitude'],
    'distinct_centroids': ['location_cluster', 'location_cluster_lat', 'location_cluster_lng'],
    'drop_model_columns': ['business_latitude', 'business_longitude'],
    'evaluate_classifier': ['accuracy', 'precision_0', 'recall_0', 'f1_0', 'precision_1', 'recall_1', 'f1_1', 'macro_precision', 'macro_recall', 'macro_f1', 'weighted_precision', 'weighted_recall', 'weighted_f1', 'u_statistic', 'roc_auc', 'mannwhitney_z', 'mean_predicted_probability_survivors', 'mean_predicted_probability_nonsurvivors'],
    'filter_bbox': ['latitude', 'longitude'],
    'first_year_aggregate': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'first_year_window': ['business_latitude', 'business_longitude'],
    'flatten_timelines': ['latitude', 'longitude'],
    'geo_feature': ['complaint_sum', 'lng', 'lat'],
    'haversine': ['meters_to_reference'],
    'impute_zero': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'incremental_source': ['value'],
    'job_panel': ['business_latitude', 'business_longitude', 'location_cluster_lat', 'location_cluster_lng'],
    'join_cluster_centers': ['business_latitude', 'business_longitude', 'location_cluster_lat', 'location_cluster_lng'],
    'join_geo': ['complaint_sum', 'latitude', 'longitude'],
    'join_survival_labels': ['business_latitude', 'business_longitude'],
    'join_training': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'join_window_counts': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'license_records': ['latitude', 'longitude'],
    'logistic_evaluation': ['accuracy', 'precision_0', 'recall_0', 'f1_0', 'precision_1', 'recall_1', 'f1_1', 'macro_precision', 'macro_recall', 'macro_f1', 'weighted_precision', 'weighted_recall', 'weighted_f1', 'u_statistic', 'roc_auc', 'mannwhitney_z', 'mean_predicted_probability_survivors', 'mean_predicted_probability_nonsurvivors'],
    'merge_panel': ['business_latitude', 'business_longitude'],
    'nearest_centroid': ['business_latitude', 'business_longitude', 'location_cluster', 'location_cluster_lat', 'location_cluster_lng'],
    'panel_finalize': ['business_latitude', 'business_longitude', 'location_cluster_lat', 'location_cluster_lng'],
    'panel_sort': ['business_latitude', 'business_longitude', 'location_cluster_lat', 'location_cluster_lng'],
    'pivot_risk_over_time': ['top_1', 'top_2', 'top_3', 'top_4', 'top_5'],
    'prepare_geojson_inputs': ['latitude', 'longitude'],
    'reference_median': ['median_lat', 'median_lng'],
    'restrict_study_window': ['business_latitude', 'business_longitude'],
    'safe_divide': ['accuracy', 'recall'],
    'scan_geojson': ['complaint_sum', 'lng', 'lat'],
    'scan_license_metadata': ['latitude', 'longitude'],
    'scan_licenses_requests': ['latitude', 'longitude'],
    'scan_panel': ['business_latitude', 'business_longitude'],
    'scan_panel_map': ['complaint_sum'],
    'scan_service_requests': ['latitude', 'longitude'],
    'scenario_profiles_cox': ['active_license_count', 'business_category_1_urgent', 'business_category_2_high', 'business_category_3_medium', 'business_category_4_not_specified', 'business_category_5_low', 'complaint_type_click', 'complaint_type_error', 'complaint_type_purchase', 'complaint_type_signup', 'complaint_type_view', 'business_latitude', 'business_longitude'],
    'scenario_profiles_logistic': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window'],
    'score_stored_cox': ['partial_hazard', 'survival_prob_6m', 'survival_prob_15m', 'survival_prob_60m', 'survival_prob_72m'],
    'score_stored_logistic': ['probability'],
    'semi_join_eligible': ['business_latitude', 'business_longitude'],
    'source_limit': ['value'],
    'split_features_target': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'standardize': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window'],
    'stratified_split': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'time_varying_panel': ['business_latitude', 'business_longitude'],
    'title_borough': ['latitude', 'longitude'],
    'training_dataset': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'union_balanced': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
    'union_profiles': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window'],
    'unpivot_nonzero_features': ['value'],
    'validate_license_metadata': ['latitude', 'longitude'],
    'variance_filter': ['active_license_count_first12m_mean', 'business_category_1_urgent_first12m_max', 'business_category_2_high_first12m_max', 'business_category_3_medium_first12m_max', 'business_category_4_not_specified_first12m_max', 'business_category_5_low_first12m_max', 'complaint_type_click_first12m_sum', 'complaint_type_error_first12m_sum', 'complaint_type_purchase_first12m_sum', 'complaint_type_signup_first12m_sum', 'complaint_type_view_first12m_sum', 'business_latitude_first12m_first', 'business_longitude_first12m_first', 'observed_months_in_first_window'],
    'write_json_artifact': ['accuracy', 'f1_0', 'f1_1', 'macro_f1', 'macro_precision', 'macro_recall', 'mannwhitney_z', 'mean_predicted_probability_nonsurvivors', 'mean_predicted_probability_survivors', 'precision_0', 'precision_1', 'recall_0', 'recall_1', 'roc_auc', 'u_statistic', 'weighted_f1', 'weighted_precision', 'weighted_recall'],
    'write_panel': ['business_latitude', 'business_longitude', 'location_cluster_lat', 'location_cluster_lng'],
    'write_table_artifact': ['active_license_count_first12m_mean', 'business_latitude_first12m_first', 'business_longitude_first12m_first'],
}
