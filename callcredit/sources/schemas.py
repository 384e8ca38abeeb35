"""Explicit schemas of the job's inputs.

The source system publishes no DDL; types follow how each column is used.
Production reads apply these schemas so a drifting file fails loudly instead
of silently changing a join key's type.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "employee": _schema(("username", S), ("team", S), ("date_valid_from", TS),
                        ("date_valid_to", TS), ("channel", S)),
    "call_log": _schema(("time_of_call_start", TS), ("resource_name", S), ("cuid", L),
                        ("durations", I), ("off_by", S), ("call_type", S), ("name", S),
                        ("custom_data_4", S)),
    "call_disp": _schema(("call_id", L), ("time_of_call_start", TS), ("time_of_call_end", TS),
                         ("durations", I), ("record_type", S), ("cuid", S),
                         ("il_communication_id", L), ("username", S), ("response_result_2", S),
                         ("code_disposition", S), ("call_list_gen", S), ("channel", S),
                         ("call_type", S), ("interaction_type_key", I), ("team", S),
                         ("orig_offer_id", L)),
    "call_backfill": _schema(("call_id", L), ("call_back_type", S), ("il_communication_id", S),
                             ("call_back_call_list", S)),
    "appl_loan": _schema(("contract_code", S), ("cuid", L), ("sign_date", TS),
                         ("preprocess_date", TS), ("approve_date", TS), ("cancel_date", TS),
                         ("product_code", S), ("product_gr", S), ("name_credit_status", S),
                         ("orig_offer_id", L)),
    "appl_card": _schema(("contract_code", S), ("cuid", L), ("sign_date", TS),
                         ("preprocess_date", TS), ("approve_date", TS), ("cancel_date", TS),
                         ("product_gr", S), ("name_credit_status", S), ("orig_offer_id", L)),
    "card_bonus": _schema(("contract_code", S), ("name_credit_status", S), ("cuid", L),
                          ("apt_date", TS), ("apt_user", S), ("apt_team", S), ("sign_date", TS),
                          ("product_code", S), ("product_gr", S),
                          ("t_amount_usage_bonus", MONEY), ("number_trans_bonus", L),
                          ("f_use", TS)),
    "operator_roster": _schema(("username", S), ("product", S), ("bonus_term", S), ("team", S)),
    "online_user": _schema(("skp_client", L), ("date_effective", TS)),
    "client_dim": _schema(("skp_client", L), ("id_cuid", L)),
    "campaign_load": _schema(("id_source", S), ("skp_client", L), ("date_campaign_start", TS),
                             ("date_campaign_end", TS), ("code_call_list_type", S),
                             ("text_name_call_list", S), ("code_output_load_type", S),
                             ("date_communication_start", TS), ("dtime_created", TS)),
    "crm_appl": _schema(("id_cuid", L), ("num_apl_contract", S), ("code_apl_prod_gr", S),
                        ("dtime_apl_sign", TS), ("dtime_apl_close", TS), ("dtime_apl_cancel", TS)),
    "contract_dim": _schema(("skp_contract", L), ("text_contract_number", S)),
    "card_account": _schema(("skp_card_account", L), ("skp_contract", L)),
    "card_txn": _schema(("skp_card_account", L), ("name_card_acceptor", S), ("amt_billing", MONEY),
                        ("dtime_auth_transaction", TS), ("date_transaction", TS),
                        ("code_card_transaction_group", S), ("skp_card_transaction_type", S),
                        ("code_status", S)),
}

INPUT_NAMES = tuple(SCHEMAS)
