"""Code-to-label tables and word lists that reports must reproduce."""

# Document status.
DOCUMENT_STATUS = {"Z": "暂存", "A": "创建", "B": "审核中", "C": "已审核", "D": "重新审核"}

# Purchase type, line termination, yes/no flags, fulfilment form.
PURCHASE_TYPE = {"A": "自采", "B": "组织间采购"}
TERMINATION = {"A": "正常", "B": "业务终止"}
YES_NO = {"1": "是", "0": "否"}
SELF_RUN = "自营"
AGENT_RUN = "非自营"
UNKNOWN = "未知"
OTHER = "其他"

# Payable business type and source document type.
BUSINESS_TYPE = {"CG": "普通采购", "FY": "费用采购", "ZC": "资产采购"}
BUSINESS_TYPE_DEFAULT = "其他采购"
SOURCE_TYPE = {
    "PUR_MRB": "采购退料单",
    "PUR_InitMRS": "期初采购退料单",
    "PAEZ_SubContract": "分包合同",
    "STK_InitInStock": "期初采购入库单",
    "STK_InStock": "采购入库单",
    "AP_Payable": "应付单",
    "IOS_APSettlement": "应付结算清单",
    "PUR_PurchaseOrder": "采购订单",
}
SOURCE_TYPE_DEFAULT = "未知源单类型"

# Ticket close status, payment status, invoicing status.
CLOSE_STATUS = {"A": "未关闭", "B": "关闭"}
PAID, PART_PAID, UNPAID, OTHER_STATUS = "已回款", "部分回款", "未回款", "其他状态"
INVOICED, PART_INVOICED, NOT_INVOICED = "已开票", "部分开票", "未开票"

# Material catalogue labels.
SHELF_STATE = {"1": "上架", "0": "下架"}
SALE_STATE = {"0": "可售", "1": "不可售"}
TAX_RATE = {
    "SL01_SYS": "17%增值税",
    "SL02_SYS": "13%增值税",
    "SL03_SYS": "7%增值税",
    "SL04_SYS": "0%增值税",
    "SL05_SYS": "11%增值税",
    "SL06_SYS": "6%增值税",
    "SL07_SYS": "3%增值税",
    "SL08_SYS": "16%增值税",
    "SL09_SYS": "1%增值税",
    "SL45_SYS": "12%增值税",
    "SL62_SYS": "10%增值税",
    "0004": "9%增值税",
    "0002": "服务费",
}
DATA_NATURE = {"1": "存量", "2": "增量", "3": "已去存"}
MATERIAL_GRADE = {"1": "主推商品属性组", "2": "常规商品属性组", "3": "零星商品属性组", "0": "未分类商品属性组"}

# Document tags of the supplier order list.
PURCHASE_ORDER_TAG, PURCHASE_RETURN_TAG = "采购订单", "采购退货"
ONLINE, OFFLINE = "电商化业务", "非电商化业务"

# Short province names, in match order.
PROVINCES = [
    "北京", "天津", "河北", "山西", "内蒙古", "辽宁", "吉林",
    "黑龙江", "上海", "江苏", "浙江", "安徽", "福建", "江西",
    "山东", "河南", "湖北", "湖南", "广东", "广西", "海南",
    "重庆", "四川", "贵州", "云南", "西藏", "陕西", "甘肃",
    "青海", "宁夏", "新疆", "台湾", "香港", "澳门",
]
