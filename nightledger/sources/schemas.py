"""Columns of the source tables, without their day partition ``dt``."""

RECHARGE = """id bigint, uid bigint, dateline bigint, rechange_channel int, money bigint, rechange_status int,
    product_id int, orderid string"""
_DEVICE = """idfa string, actid bigint, ipaddr bigint, channelid string, chantype int, chanver int, chancode int,
    terminal int, appver int"""
PAY_REQUEST = f"id bigint, uid bigint, dateline bigint, {_DEVICE}"
ONLINE_DETAIL = PAY_REQUEST
LEDGER = "id bigint, uid bigint, dateline bigint, money bigint, productid int, salesperson string"
REGISTER_LIST = "uid bigint, special int"
UID_LIST = "uid bigint"
ACTIVATION = "id bigint, idfa string"
HEARTBEAT = """id bigint, uid bigint, idfa string, roomid bigint, terminal int, dateline bigint, channelid string,
    ipaddr bigint"""
WORKLOAD = "roomid bigint, start_dt bigint, end_dt bigint, total bigint, dateline bigint"
REQUEST_LOG = """id bigint, uid bigint, dateline bigint, macaddr string, idfa string, channelid string, terminal int,
    action string, ipaddr string, idfv int"""
FIRST_VISIT = "idfa string, ipaddr bigint, channel_id string, device_type int, dateline bigint"
ONLINE = "id bigint, uid bigint, dateline bigint, idfa string, channel_id string, device_type int"
REGISTER_DETAIL = "id bigint, uid bigint, idfa string, channel_id string, device_type int, qqstatus int, dateline bigint"
SPEND = """id bigint, uid bigint, roomid bigint, dateline bigint, consume_coin bigint, consume_type int,
    consume_type_son bigint, consume_id bigint, consume_num bigint, dj_hot bigint, dj_diamond bigint, anchor_uid bigint"""
CHANNEL_PRICE = "code string, channel_platform int, start_price decimal(10,2), statis_type int"
CHANNEL_DISCOUNT = "id bigint, channelid string, grade int, discount decimal(10,4)"
PARTNER = """partner_id bigint, partner_name string, channelid string, type int, status int, cut_rate int,
    price decimal(10,2)"""
QUOTA = "channel_id string, total bigint, remain bigint"
USER = "uid bigint, cr_dt bigint, channelid string, showid bigint, qqstatus int, renrenstatus int"
USER_STATUS = "uid bigint, lastactivitytime bigint, lastip string, macaddr string"
USER_PROFILE = "uid bigint, nickname string"
CHAT_HISTORY = "from_uid bigint, dateline bigint"
FIRST_RECHARGE = "uid bigint, money bigint, type int, first_second int, dateline bigint"
CHANNEL_CONFIG = "chancode int, channame string, statis_type int"
CHECKSUM = "idfa string, md5 int"
CHAT = "uid bigint, chat_num bigint"
FLOWER = "uid bigint, flower_num bigint"
PURE_VISITOR = "idfa string, channel_id string, device_type int"
PURE_VISITOR_RESULT = "channel_id string, device_type int, non_added_pure_visitor bigint"
INCOME_DAILY = "uid bigint, money bigint, special int, success int"
# The nine spending logs, and the prices of props and gifts.
PROPS = """uid bigint, fuid bigint, category int, admin_prop_id bigint, total bigint, spend bigint, dateline bigint"""
GAMES = """uid bigint, roomid bigint, gameid int, spend_money bigint, admin_gift_id bigint, gift_num bigint, dateline bigint"""
SHOW_GIFTS = """sender bigint, uid bigint, roomid bigint, note string, spendmoney bigint, cust_gift_id bigint,
    admin_gift_id bigint, realnum bigint, dateline bigint"""
GIFTS = "admin_gift_id bigint, sender bigint, uid bigint, dateline bigint"
MEMBERSHIPS = "uid bigint, money bigint, vip bigint, dateline bigint"
SONGS = "uid bigint, roomid bigint, coin bigint, status int, dateline bigint"
CROWNS = "uid bigint, cost bigint, ref_giftid bigint, fuid bigint, status int, dateline bigint"
RED_PACKETS = "send_uid bigint, roomid bigint, type int, amount bigint, dateline bigint"
PROP_PRICES = "admin_prop_id bigint, price bigint"
GIFT_COSTS = "giftid bigint, cost bigint"
DIAMONDS = "roomid bigint, fuid bigint, is_anchor int, category int, diamond bigint, dateline bigint"
ROSTER = "roomid bigint, nickname string, level int"
DWELL_LOG = "uid bigint, roomid bigint, dateline bigint, longs bigint"
ROOM_LEVELS = "roomid bigint, date_time int, level int"
ROOM_LIST = "roomid bigint"
HOST_GENDER = "roomid bigint, gender int"
SLOT_LOG = "roomid bigint, cal_rank int"
RECOMMENDED = "roomid bigint, dateline bigint"
