"""Report texts and levels.

Fixed values: downstream consumers match on these exact strings.
"""

CRITICAL = "CRITICAL"
WARNING = "WARNING"
INFO = "INFO"

HIGH = "HIGH"
MEDIUM = "MEDIUM"
LOW = "LOW"

CALL_DROP = "通话下降"
DATA_DROP = "流量下降"

ADVICE_HIGH = "高价值客户沉默, 建议客服48小时内回访"
ADVICE_MEDIUM = "中等价值客户, 建议推送优惠活动召回"
ADVICE_LOW = "低价值客户, 建议短信营销触达"

SILENT_VERY_HIGH = "高沉默率: "
SILENT_ELEVATED = "沉默率偏高: "
ZERO_CALLS = "零通话率: "
ZERO_DATA = "零数据率: "
HIGH_VALUE_SILENT = "高价值客户沉默: "
REASON_SEPARATOR = " | "
NO_REASON = "Normal"
