"""Schemas of all tables as DDL strings: nothing is inferred at read time."""

BRONZE_TICKS = (
    "event_id STRING, security_id INT, mode STRING, ltp DOUBLE, bid DOUBLE, ask DOUBLE, oi BIGINT, change DOUBLE, "
    "last_trade_time BIGINT, last_trade_volume BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
    "total_bid_qty BIGINT, total_ask_qty BIGINT, capture_timestamp_ns BIGINT, connection_id STRING"
)
QUARANTINE = (
    "event_id STRING, connection_id STRING, websocket_message_id INT, packet_offset INT, receive_ts_ns BIGINT, "
    "security_id INT, payload_hash STRING, decoder_version STRING, decode_status STRING, raw_payload_hex STRING, "
    "written_at STRING"
)
ENVELOPE = (
    "schema_version INT, event_id STRING, connection_id STRING, websocket_message_id INT, packet_offset INT, "
    "receive_ts_ns BIGINT, exchange_ts_ns BIGINT, response_code INT, security_id INT, exchange_segment INT, "
    "raw_payload BINARY, payload_hash STRING, decoder_version STRING, decode_status STRING, decoded_payload STRING"
)
BARS = (
    "security_id BIGINT, event_time TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT, "
    "volume_delta BIGINT, oi_open BIGINT, oi_high BIGINT, oi_low BIGINT, oi_close BIGINT, trade_count BIGINT, "
    "revision INT, is_corrected BOOLEAN, correction_of TIMESTAMP"
)
FEATURES = (
    "security_id BIGINT, event_time TIMESTAMP, returns DOUBLE, range DOUBLE, atr DOUBLE, vwap DOUBLE, rsi DOUBLE, "
    "rvol DOUBLE, oi_change DOUBLE, minutes_to_expiry DOUBLE"
)
INSTRUMENTS = (
    "security_id BIGINT, symbol STRING, exchange STRING, segment STRING, instrument_type STRING, expiry_date DATE, "
    "strike_price DOUBLE, option_type STRING, lot_size INT, tick_size DOUBLE, strike_interval DOUBLE, "
    "underlying_security_id BIGINT, isin STRING, nse_symbol STRING, bse_symbol STRING, dv_symbol STRING, source STRING, "
    "snapshot_date DATE, valid_from DATE, valid_to DATE, is_current BOOLEAN, checksum STRING"
)
SNAPSHOT_LOG = "snapshot_date DATE, loaded_at TIMESTAMP, row_count BIGINT, checksum STRING, status STRING"
MEMBERSHIP = "symbol STRING, isin STRING, effective_from DATE, effective_to DATE, is_current BOOLEAN"
ELIGIBILITY = "symbol STRING, effective_from DATE, effective_to DATE, is_current BOOLEAN"
UNIVERSE = (
    "universe_snapshot_id STRING, snapshot_date DATE, created_at TIMESTAMP, members ARRAY<STRING>, "
    "eligible ARRAY<STRING>, expiry_dates MAP<STRING,STRING>, atm_strikes MAP<STRING,DOUBLE>, contracts ARRAY<STRING>, "
    "contract_count INT"
)
PREDICTIONS = (
    "prediction_id STRING, universe_snapshot_id STRING, security_id BIGINT, prediction_time TIMESTAMP, "
    "feature_available_time TIMESTAMP, model_id STRING, dataset_id STRING, score DOUBLE"
)
FRAMES = "frame BINARY, receive_ts_ns BIGINT, connection_id STRING, websocket_message_id INT"
PACKETS = (
    "receive_ts_ns BIGINT, connection_id STRING, websocket_message_id INT, packet_offset INT, packet_type STRING, "
    "response_code INT, exchange_segment INT, security_id BIGINT, ltp FLOAT, last_trade_time BIGINT, "
    "last_trade_qty INT, atp FLOAT, volume BIGINT, total_sell_qty BIGINT, total_buy_qty BIGINT, day_open FLOAT, "
    "day_close FLOAT, day_high FLOAT, day_low FLOAT, oi BIGINT, prev_close FLOAT, prev_oi BIGINT, "
    "depth ARRAY<STRUCT<bid_qty: INT, ask_qty: INT, bid_orders: INT, ask_orders: INT, bid: FLOAT, ask: FLOAT>>"
)
