"""Logical tables: columns, keys and references."""

from __future__ import annotations

TABLES = {
    "client_master": "client_id string, client_name string, client_industry string, date_added timestamp",
    "supplier_master": "global_supplier_id string, normalized_supplier_name string, date_added timestamp",
    "supplier_attributes": (
        "global_supplier_id string, supplier_description string, employee_count string, revenue string, year_established string, l1_category string, l2_category string, "
        "l3_category string, product_service_tags string, ship_to_countries string, country_codes string, date_added timestamp"
    ),
    "client_supplier_data": (
        "client_id string, global_supplier_id string, item_description string, l1_category string, l2_category string, l3_category string, spend_year int, spend_month int, "
        "client_industry string, total_spend decimal(18,4), total_quantity decimal(18,4), unit_of_measure string, unit_price decimal(18,4), currency string, ship_to_countries string, "
        "country_codes string, tags string, preferred_flag_original string, preferred_flag_normalized string, date_added timestamp, date_refreshed timestamp, first_invoice_date date, payment_terms string"
    ),
    "supplier_crosswalk": "client_id string, supplier_id string, global_supplier_id string, match_method string, match_confidence double, matched_on string, date_added timestamp",
    "transactions": (
        "row_id long, client_id string, upload_id string, global_supplier_id string, supplier_id string, supplier_name_normalized string, l1_category string, l2_category string, "
        "l3_category string, country_code string, po_number string, amount decimal(18,4), currency string, quantity decimal(18,4), created_at timestamp"
    ),
    "transactions_extra": "client_id string, upload_id string, row_id string, extra_columns map<string,string>",
    "transactions_raw": "client_id string, upload_id string, original_columns map<string,string>, file_name string, uploaded_at timestamp",
    "vector_embeddings": "client_id string, global_supplier_id string, chunk_id string, embedding array<float>, source_text string, indexed_at timestamp",
    "run_log": "run_id string, stage string, status string, row_count long, error_message string, timestamp timestamp",
}
KEYS = {
    "client_master": ["client_id"], "supplier_master": ["global_supplier_id"], "supplier_attributes": ["global_supplier_id"],
    "client_supplier_data": ["client_id", "global_supplier_id"], "supplier_crosswalk": ["client_id", "supplier_id"], "transactions": ["row_id"],
    "vector_embeddings": ["client_id", "global_supplier_id", "chunk_id"],
}
NOT_NULL = {"client_master": ["client_name"], "supplier_master": ["normalized_supplier_name"], "transactions": ["global_supplier_id"]}
FOREIGN = [(t, "global_supplier_id", "supplier_master", "global_supplier_id") for t in ("supplier_attributes", "client_supplier_data", "supplier_crosswalk", "transactions")]

MASTER_FILE = (
    "Normalized_Supplier_Name string, Original_Name_Variants string, Supplier_Description string, Employee_Count string, Revenue string, Year_Established string, Overall_Category string, "
    "Category_Code string, Category_Name string, Category_Confidence string, L3_Token_Probability string, Confidence_Reasoning string, Product_Service_Tags string, Total_PO_Items bigint, "
    "Ship_To_Countries string, Country_Codes string, Last_Updated string"
)


def empty(spark, name: str):
    return spark.createDataFrame([], TABLES[name])
