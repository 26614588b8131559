"""Feed layouts, table names and row contracts."""

from __future__ import annotations

# Columns of the daily price feed of the first exchange, with their types.
PRICE_FEED = {
    "TradDt": "string", "BizDt": "string", "Sgmt": "string", "Src": "string", "FinInstrmTp": "string",
    "FinInstrmId": "string", "ISIN": "string", "TckrSymb": "string", "SctySrs": "string", "XpryDt": "string",
    "FininstrmActlXpryDt": "string", "StrkPric": "double", "OptnTp": "string", "FinInstrmNm": "string",
    "OpnPric": "double", "HghPric": "double", "LwPric": "double", "ClsPric": "double", "LastPric": "double",
    "PrvsClsgPric": "double", "UndrlygPric": "double", "SttlmPric": "double", "OpnIntrst": "bigint",
    "ChngInOpnIntrst": "bigint", "TtlTradgVol": "bigint", "TtlTrfVal": "double", "TtlNbOfTxsExctd": "bigint",
    "SsnId": "string", "NewBrdLotQty": "bigint", "Rmks": "string", "Rsvd01": "string", "Rsvd02": "string",
    "Rsvd03": "string", "Rsvd04": "string",
}

# Columns of the daily price feed of the second exchange, with their types.
SECOND_FEED = {
    "SC_CODE": "string", "SC_NAME": "string", "SC_GROUP": "string", "SC_TYPE": "string", "OPEN": "double",
    "HIGH": "double", "LOW": "double", "CLOSE": "double", "LAST": "double", "PREVCLOSE": "double",
    "NO_TRADES": "bigint", "NO_OF_SHRS": "bigint", "NET_TURNOV": "double", "TDCLOINDI": "string",
    "ISIN_CODE": "string",
}

# Columns of the symbol master and the corporate-action feed.
MASTER_FEED = {
    "SYMBOL": "string", "NAME OF COMPANY": "string", "SERIES": "string", "DATE OF LISTING": "string",
    "PAID UP VALUE": "double", "MARKET LOT": "bigint", "ISIN NUMBER": "string", "FACE VALUE": "double",
}
ACTION_FEED = (
    "SYMBOL", "COMPANY", "SERIES", "FACE VALUE", "PURPOSE", "EX-DATE", "RECORD DATE", "BC START DATE",
    "BC END DATE", "ND START DATE", "ND END DATE", "ACTUAL PAYMENT DATE",
)

# Normalised name -> price-feed name used by the serving table.
SERVING_NAMES = {
    "trade_date": "TradDt", "symbol": "TckrSymb", "open": "OpnPric", "high": "HghPric", "low": "LwPric",
    "close": "ClsPric", "last_price": "LastPric", "prev_close": "PrvsClsgPric", "settlement_price": "SttlmPric",
    "volume": "TtlTradgVol", "turnover": "TtlTrfVal", "trades": "TtlNbOfTxsExctd", "isin": "ISIN",
    "instrument_id": "FinInstrmId", "instrument_type": "FinInstrmTp", "instrument_name": "FinInstrmNm",
    "segment": "Sgmt", "series": "SctySrs", "exchange": "Src", "business_date": "BizDt", "expiry_date": "XpryDt",
    "strike_price": "StrkPric", "option_type": "OptnTp", "underlying_price": "UndrlygPric",
    "open_interest": "OpnIntrst", "change_in_oi": "ChngInOpnIntrst", "session_id": "SsnId",
    "board_lot_qty": "NewBrdLotQty", "remarks": "Rmks",
}

# Retention of the serving tables in years, with the date that ages a row.
RETENTION_YEARS = {
    "raw_equity_ohlc": ("TradDt", 5), "normalized_equity_ohlc": ("trade_date", 3),
    "features_equity_indicators": ("trade_date", 1), "corporate_actions": ("ex_date", 10),
    "symbol_master": ("valid_from", 10), "index_constituent": ("effective_date", 10),
    "trading_calendar": ("trade_date", 10), "bulk_block_deals": ("deal_date", 10),
    "quarterly_financials": ("period_end_date", 10), "shareholding_pattern": ("quarter_end_date", 10),
    "macro_indicators": ("indicator_date", 20),
}

# Partition columns of the lake tables.
LAYOUTS = {
    "raw_equity_ohlc": ("trade_date", ("year", "month", "day")),
    "normalized_equity_ohlc": ("trade_date", ("year", "month", "day")),
    "corporate_actions": ("ex_date", ("year",)),
    "bulk_block_deals": ("deal_date", ("deal_type", "year", "month")),
    "index_constituent": ("effective_date", ("index_name", "year", "month", "day")),
    "option_chain": ("date", ("date", "symbol")),
    "quarterly_financials": ("period_end_date", ("symbol", "year", "quarter")),
    "shareholding_pattern": ("quarter_end_date", ("year", "quarter")),
    "macro_indicators": ("indicator_date", ("category", "year")),
}

# Row contract of normalised prices, field -> what a value must satisfy.
NORMALIZED_CONTRACT = {
    "event_id": {"required": True, "type": "string"},
    "event_time": {"required": True, "type": "timestamp"},
    "ingest_time": {"required": True, "type": "timestamp"},
    "source": {"required": True, "type": "string", "min_length": 1},
    "schema_version": {"required": True, "type": "string", "pattern": "^v[0-9]+$"},
    "entity_id": {"required": True, "type": "string", "min_length": 1},
    "instrument_id": {"required": True, "type": "string", "min_length": 1},
    "symbol": {"required": True, "type": "string", "min_length": 1},
    "exchange": {"required": True, "type": "string", "one_of": ("NSE", "BSE")},
    "isin": {"type": "string", "pattern": "^([A-Z]{2}[A-Z0-9]{9}[0-9])?$"},
    "instrument_type": {"type": "string", "one_of": ("STK", "FUT", "OPT", "IDX")},
    "series": {"type": "string"},
    "trade_date": {"required": True, "type": "date"},
    "prev_close": {"type": "double", "minimum": 0},
    "open": {"required": True, "type": "double", "minimum": 0},
    "high": {"required": True, "type": "double", "minimum": 0},
    "low": {"required": True, "type": "double", "minimum": 0},
    "close": {"required": True, "type": "double", "minimum": 0},
    "last_price": {"type": "double", "minimum": 0},
    "settlement_price": {"type": "double", "minimum": 0},
    "volume": {"required": True, "type": "bigint", "minimum": 0},
    "turnover": {"required": True, "type": "double", "minimum": 0},
    "trades": {"type": "bigint", "minimum": 0},
    "adjustment_factor": {"required": True, "type": "double", "above": 0},
    "adjustment_date": {"type": "date"},
    "is_trading_day": {"required": True, "type": "boolean"},
}
