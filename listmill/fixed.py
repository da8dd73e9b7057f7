"""Word lists, lookup tables and formats that results depend on."""

# topic -> served table
TOPIC_TABLES = {
    "nhamatpho": "nhamatpho_index",
    "bietthu": "bietthu_index",
    "chungcu": "chungcu_index",
    "nharieng": "nharieng_index",
}

# word in a crawl file name -> served table; the longest word wins
FILE_TABLES = {
    "nhamatpho": "nhamatpho_index",
    "nharieng": "nharieng_index",
    "nhatro": "nharieng_index",
    "chungcu": "chungcu_index",
    "datbietthu": "dat_index",
    "bietthu": "bietthu_index",
    "dat": "dat_index",
    "khoxuong": "khac_index",
    "thuekho": "khac_index",
    "vanphong": "khac_index",
    "cuahang": "khac_index",
    "nhadatkhac": "khac_index",
    "thuekhac": "khac_index",
}
FILE_TABLE_DEFAULT = "bds_khac_index"

# category word of a search request -> served table
SEARCH_TABLES = {
    "nhà mặt phố": "nhamatpho_index",
    "nhà phố": "nhamatpho_index",
    "nhà riêng": "nharieng_index",
    "nhà trọ": "nharieng_index",
    "phòng trọ": "nharieng_index",
    "chung cư": "chungcu_index",
    "tập thể": "chungcu_index",
    "căn hộ": "chungcu_index",
    "biệt thự": "bietthu_index",
    "liền kề": "bietthu_index",
    "đất biệt thự": "dat_index",
    "đất": "dat_index",
    "đất nền": "dat_index",
    "đất mặt phố": "dat_index",
    "đất riêng": "dat_index",
    "đất trang trại": "dat_index",
    "kho xưởng": "khac_index",
    "nhà xưởng": "khac_index",
    "thuê kho": "khac_index",
    "văn phòng": "khac_index",
    "cửa hàng": "khac_index",
    "nhà đất khác": "khac_index",
}
SEARCH_TABLES_DEFAULT = ["nhamatpho_index", "nharieng_index", "chungcu_index", "bietthu_index"]

# words that mark a listing as a rental
RENT_WORDS = ["thuê", "thue"]

# prefixes removed from a category label, one after the other
LABEL_PREFIXES = ["Cho thuể", "Mua bán", "Căn hộ"]

# category label -> served label
LABEL_MAP_BATCH = {
    "Biệt thự, liền kề": "Biệt thự liền kề",
    "Nhà biệt thự liền kề": "Biệt thự liền kề",
    "Nhà mặt phố": "Nhà mặt tiền",
    "Phòng trọ, nhà trọ, nhà trọ": "Phòng trọ, nhà trọ",
    "Phòng trọ": "Phòng trọ, nhà trọ",
    "Trang trại, khu nghỉ dưỡng": "Trang trại khu nghỉ dưỡng",
    "Kho nhà xưởng": "Kho xưởng",
    "Kho, xưởng": "Kho xưởng",
}
LABEL_MAP_STREAM = {
    "Biệt thự, liền kề": "Biệt thự liền kề",
    "Nhà biệt thự liền kề": "Biệt thự liền kề",
    "Nhà mặt phố": "Nhà mặt tiền",
    "Chung cư": "Chung cư",
    "Căn hộ": "Chung cư",
}
LABEL_DEFAULT = "Khác"

# category code of the two crawled sites -> label
SITE_A_CODES = {0: "Nhà phố", 1: "Nhà riêng", 2: "Chung cư", 3: "Biệt thự"}
SITE_B_CODES = {
    0: "Nhà phố",
    1: "Nhà riêng",
    2: "Chung cư",
    3: "Biệt thự",
    4: "Đất biệt thự",
    5: "Đất mặt tiền",
    6: "Đất",
    7: "Đất trang trại",
    8: "Kho xưởng",
    9: "Nhà đất khác",
    10: "Chung cư cho thuê",
    11: "Nhà riêng cho thuê",
    12: "Nhà mặt tiền cho thuê",
    13: "Văn phòng cho thuê",
    14: "Cửa hàng cho thuê",
    15: "Kho xưởng cho thuê",
    16: "Nhà trọ cho thuê",
    17: "Bất động sản cho thuê khác",
}

# attribute -> source keys of the extras map, in order of preference (exact keys)
EXTRA_KEYS = {
    "no_bedrooms": ["Số Phòng Ngủ", "Số phòng ngủ :"],
    "no_bathrooms": ["Số Phòng Tắm", "Số toilet :"],
    "front_road": ["Đường Trước Nhà"],
    "front_face": ["Mặt Tiền"],
    "no_floors": ["Số Tầng", "Tầng :"],
    "direction": ["Hướng Nhà"],
    "ultilization_square": ["Diện Tích Sử Dụng"],
    "yo_construction": ["Năm xây dựng"],
}

# attribute -> words looked for inside the keys of the extras map (any case)
EXTRA_WORDS = {
    "no_bedrooms": ["Số Phòng Ngủ", "Số phòng ngủ :", "phòng ngủ"],
    "no_bathrooms": ["Số Phòng Tắm", "Số toilet :", "phòng tắm", "wc"],
    "front_road": ["Đường Trước Nhà"],
    "front_face": ["Mặt Tiền"],
    "no_floors": ["Số Tầng", "Tầng :", "số tầng"],
    "direction": ["Hướng Nhà", "hướng"],
    "ultilization_square": ["Diện Tích Sử Dụng"],
    "yo_construction": ["Năm xây dựng"],
    "legal": ["Pháp lý", "Giấy tờ pháp lý"],
}

# administrative prefixes removed from a place name
PLACE_PREFIXES = [
    "Thành phố", "Thành Phố", "Tỉnh",
    "Quận", "Thành phố", "Thành Phố", "Thị xã", "Thị Xã", "Huyện",
    "Phường", "Xã", "Thị trấn",
]

# URL slug -> province name
PROVINCE_SLUGS = {
    "ha-noi": "Hà Nội",
    "ha-giang": "Hà Giang",
    "cao-bang": "Cao Bằng",
    "bac-kan": "Bắc Kạn",
    "tuyen-quang": "Tuyên Quang",
    "lao-cai": "Lào Cai",
    "dien-bien": "Điện Biên",
    "lai-chau": "Lai Châu",
    "son-la": "Sơn La",
    "yen-bai": "Yên Bái",
    "hoa-binh": "Hòa Bình",
    "thai-nguyen": "Thái Nguyên",
    "lang-son": "Lạng Sơn",
    "quang-ninh": "Quảng Ninh",
    "bac-giang": "Bắc Giang",
    "phu-tho": "Phú Thọ",
    "vinh-phuc": "Vĩnh Phúc",
    "bac-ninh": "Bắc Ninh",
    "hai-duong": "Hải Dương",
    "hai-phong": "Hải Phòng",
    "hung-yen": "Hưng Yên",
    "thai-binh": "Thái Bình",
    "ha-nam": "Hà Nam",
    "nam-dinh": "Nam Định",
    "ninh-binh": "Ninh Bình",
    "thanh-hoa": "Thanh Hóa",
    "nghe-an": "Nghệ An",
    "ha-tinh": "Hà Tĩnh",
    "quang-binh": "Quảng Bình",
    "quang-tri": "Quảng Trị",
    "thua-thien-hue": "Thừa Thiên Huế",
    "da-nang": "Đà Nẵng",
    "quang-nam": "Quảng Nam",
    "quang-ngai": "Quảng Ngãi",
    "binh-dinh": "Bình Định",
    "phu-yen": "Phú Yên",
    "khanh-hoa": "Khánh Hòa",
    "ninh-thuan": "Ninh Thuận",
    "binh-thuan": "Bình Thuận",
    "kon-tum": "Kon Tum",
    "gia-lai": "Gia Lai",
    "dak-lak": "Đắk Lắk",
    "dak-nong": "Đắk Nông",
    "lam-dong": "Lâm Đồng",
    "binh-phuoc": "Bình Phước",
    "tay-ninh": "Tây Ninh",
    "binh-duong": "Bình Dương",
    "dong-nai": "Đồng Nai",
    "ba-ria-vung-tau": "Bà Rịa - Vũng Tàu",
    "tp-ho-chi-minh": "TP. Hồ Chí Minh",
    "ho-chi-minh": "Hồ Chí Minh",
    "long-an": "Long An",
    "tien-giang": "Tiền Giang",
    "ben-tre": "Bến Tre",
    "tra-vinh": "Trà Vinh",
    "vinh-long": "Vĩnh Long",
    "dong-thap": "Đồng Tháp",
    "an-giang": "An Giang",
    "kien-giang": "Kiên Giang",
    "can-tho": "Cần Thơ",
    "hau-giang": "Hậu Giang",
    "soc-trang": "Sóc Trăng",
    "bac-lieu": "Bạc Liêu",
    "ca-mau": "Cà Mau",
}

# text for "price to be agreed"
PRICE_ON_REQUEST = "thỏa thuận"

# marker behind a shortened chat message, and the length kept
TRUNCATE_AT = 4000
TRUNCATE_MARK = "\n...[Nội dung quá dài đã được cắt bớt để lưu vào bộ nhớ]..."

# e-mail form
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# map centre when no district has coordinates
DEFAULT_CENTRE = (21.0285, 105.8542)

STAMP_FORMAT = "yyyy/MM/dd HH:mm:ss"
