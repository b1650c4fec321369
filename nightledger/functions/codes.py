"""Fixed values shared by the jobs. Jobs take them as parameter defaults."""

# accounts
VISITOR_UID = 3000006
SYSTEM_UID = 3000096
SIGNUP_MIN_UID = 79600000

# Total row
TOTAL_ROOM = 100
TOTAL_NAME = "总计"

# Payment codes
PAY_SUCCESS = 30
OFFICIAL_BELOW = 10
COIN_FROM = 20
AGENT_TYPE = 10
AGENT_OTHER_TYPE = 11
AGENT_PRODUCT = 147
AGENT_OTHER_PRODUCT = 149
INCOME_TYPES = (3, 4, 5, 6, 8, 9, 10, 21, 22, 23, 24)
INTERNAL_AGENTS = ("dl_dzlf", "jzljs", "dl_tianli_7328", "ywdl", "czdl_g2_xs")

# Income labels
LABEL_NORMAL = 0
LABEL_SPECIAL_CHANNEL = 1
LABEL_HOST = 2
LABEL_INTERNAL = 3
LABEL_FARMER = 4

# Product prefixes inside a channel id
WEB = "10301"
ANDROID = "s10202"
IPHONE = "10102"
IPAD = "10135"
H5 = "10536"

# Device types
DEVICE_WEB = 1
DEVICE_ANDROID = 2
DEVICE_IPHONE = 3
DEVICE_IPAD = 4
PLATFORM_NAMES = {1: "Web", 2: "安卓", 3: "iPhone", 4: "iPad"}

# Channel codes and placeholders
EXCLUDED_CODE = "2138"
UNLIMITED_CODE = "2163"
LONG_ANDROID_CODE = "2130"
LONG_IPHONE_CODE = "2131"
PLACEHOLDER_CHANNEL = "EN_APP_KEY_PLACEHOLDER"
JUNK_CHANNELS = ("0", "", "yibao", "EN_APP_KEY_PLACEHOLDER")
ANDROID_STANDARD_TAIL = "102000"
IOS_STANDARD_TAIL = "100100"

# Version gates
MIN_QUALITY_VERSION = 753
MIN_SETTLED_VERSION = 763

# Login-rate baselines by standard-channel class
LOGIN_BASELINES = {1: "0.5", 2: "0.48", 3: "0.6"}

# Request actions
ACTION_NOTICE = "serv_getnotif"
ACTION_LOGIN_QQ = "serv_loginqq"
ACTION_LOGIN_WEIXIN = "serv_loginweixin"

# Nickname fragments looked for at sign-up
NICKNAME_FRAGMENTS = ("共用出口", "机房")

# Spend types
SPEND_SHOW_PROP = 10
SPEND_GAME = 11
SPEND_SHOW_GIFT = 12
SPEND_SONG = 13
SPEND_RED_PACKET = 14
SPEND_PROP = 20
SPEND_GIFT = 21
SPEND_MEMBERSHIP = 22
SPEND_CROWN = 23

# First-pay report levels
LEVEL_LEAF = 0
LEVEL_DAY = 1
LEVEL_PARENT = 2
LEVEL_NAMES = {
    1: "每天总计",
    4: "安卓CPA",
    5: "安卓CPC",
    6: "安卓电子市场",
    7: "iOS官网",
    8: "iPad",
    9: "iOS CPA",
}
LABEL_DAY_COUNT = "渠道总数: "
LABEL_SUB_COUNT = "子渠道总数: "
