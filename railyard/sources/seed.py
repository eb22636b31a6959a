"""The sample data: a small network with six trains, before any booking.

All literals below are fixed values of the sample data set.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import password_hash
from ..operators.lifecycle_jobs import generate_seats
from ..plans.tables import Tables
from ..schemas import TABLES
from .star import policies

# Name, e-mail, phone, password, type
USERS = (
    ("Nguyễn Văn An", "nguyenvanan@email.com", "0901234567", "hash_password_123", "Customer"),
    ("Trần Thị Bình", "tranthib@email.com", "0902234567", "hash_password_456", "Customer"),
    ("Lê Văn Cường", "levancuong@email.com", "0903234567", "hash_password_789", "Staff"),
    ("Phạm Thị Dung", "phamthidung@email.com", "0904234567", "hash_password_abc", "Admin"),
    ("Hoàng Văn Em", "hoangvanem@email.com", "0905234567", "hash_password_def", "Customer"),
    ("Đỗ Thị Phương", "dothiphuong@email.com", "0906234567", "hash_password_ghi", "Customer"),
)

# Code, name, city, province, address
STATIONS = (
    ("HN", "Hà Nội", "Hà Nội", "Hà Nội", "120 Lê Duẩn, Hoàn Kiếm"),
    ("HP", "Hải Phòng", "Hải Phòng", "Hải Phòng", "75 Lương Khánh Thiện"),
    ("VT", "Vinh", "Vinh", "Nghệ An", "Đường Lê Lợi"),
    ("HUE", "Huế", "Huế", "Thừa Thiên Huế", "2 Bùi Thị Xuân"),
    ("DN", "Đà Nẵng", "Đà Nẵng", "Đà Nẵng", "202 Hải Phòng"),
    ("QN", "Quảng Ngãi", "Quảng Ngãi", "Quảng Ngãi", "Đường Quang Trung"),
    ("NHA", "Nha Trang", "Nha Trang", "Khánh Hòa", "26 Thái Nguyên"),
    ("SG", "Sài Gòn", "TP. Hồ Chí Minh", "TP. Hồ Chí Minh", "1 Nguyễn Thông, Q.3"),
)

# Code, departure station, arrival station, kilometres, minutes
ROUTES = (
    ("HN-SG", 1, 8, 1726, 1920),
    ("HN-DN", 1, 5, 764, 780),
    ("HN-HUE", 1, 4, 658, 660),
    ("DN-SG", 5, 8, 964, 900),
    ("HN-VT", 1, 3, 319, 360),
    ("HUE-SG", 4, 8, 1068, 1080),
)

# Class name, description, price multiplier
CLASSES = (
    ("Ghế cứng", "Ghế ngồi cứng, phù hợp quãng đường ngắn", "1.00"),
    ("Ghế mềm điều hòa", "Ghế ngồi mềm có điều hòa", "1.30"),
    ("Giường nằm khoang 6", "Giường nằm 6 người/khoang", "1.50"),
    ("Giường nằm khoang 4", "Giường nằm 4 người/khoang, cao cấp", "2.00"),
    ("Giường nằm VIP", "Giường nằm 2 người/khoang, cao cấp nhất", "2.50"),
)

# Code, name, type, declared coaches
TRAINS = (
    ("SE1", "Thống Nhất SE1", "SE", 12),
    ("SE2", "Thống Nhất SE2", "SE", 12),
    ("SE3", "Thống Nhất SE3", "SE", 10),
    ("SE4", "Thống Nhất SE4", "SE", 10),
    ("TN1", "Tàu Nhanh TN1", "TN", 8),
    ("SNT1", "Sài Gòn - Nha Trang", "SNT", 6),
)

# Train, coach number, class, seats
COACHES = (
    (1, 1, 1, 64),
    (1, 2, 1, 64),
    (1, 3, 2, 52),
    (1, 4, 2, 52),
    (1, 5, 3, 36),
    (1, 6, 3, 36),
    (1, 7, 4, 24),
    (1, 8, 4, 24),
    (1, 9, 5, 12),
    (2, 1, 1, 64),
    (2, 2, 2, 52),
    (2, 3, 3, 36),
    (2, 4, 4, 24),
)
COACHES_WITHOUT_SEATS = (2, 3, 4)

# Train, route, departure, arrival, base price, free seats
SCHEDULES = (
    (1, 1, "2025-11-25 19:00", "2025-11-26 03:00", 800000, 350),
    (2, 1, "2025-11-02 06:00", "2025-11-03 14:00", 800000, 350),
    (3, 2, "2025-11-01 22:00", "2025-11-02 11:00", 450000, 280),
    (4, 2, "2025-11-02 08:00", "2025-11-02 21:00", 450000, 280),
    (5, 3, "2025-11-18 14:00", "2025-11-19 01:00", 350000, 220),
    (1, 1, "2025-11-20 19:00", "2025-11-21 03:00", 850000, 350),
)

CREATED = dt.datetime(2025, 11, 1)


def frame(spark: SparkSession, table: str, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), TABLES[table].struct)


def seed_tables(spark: SparkSession) -> Tables:
    plain = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(USERS, 1)],
        "UserID bigint, FullName string, Email string, PhoneNumber string, password string,"
        " UserType string",
    )
    users = plain.select(
        "UserID",
        "FullName",
        "Email",
        "PhoneNumber",
        password_hash(F.col("password")).alias("PasswordHash"),
        "UserType",
        F.lit(True).alias("IsActive"),
        F.lit(str(CREATED)).cast("timestamp_ntz").alias("CreatedAt"),
    )
    coaches = frame(spark, "Coaches", [(i, *row) for i, row in enumerate(COACHES, 1)])
    # ids follow coach and seat number; the coaches have at most 64 seats each
    seated = generate_seats(coaches.filter(~F.col("CoachID").isin(*COACHES_WITHOUT_SEATS)))
    before = {}
    total = 0
    for i, row in enumerate(COACHES, 1):
        before[i] = total
        total += 0 if i in COACHES_WITHOUT_SEATS else row[3]
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    seats = seated.select(
        (offset[F.col("CoachID")] + F.col("SeatNumber").cast("int")).cast("bigint").alias("SeatID"),
        "CoachID",
        "SeatNumber",
        "SeatType",
    )
    at = dt.datetime.fromisoformat
    frames = {
        "Users": users,
        "Stations": frame(
            spark, "Stations", [(i, *row, True) for i, row in enumerate(STATIONS, 1)]
        ),
        "Routes": frame(
            spark,
            "Routes",
            [(i, c, d, a, Decimal(km), m, True) for i, (c, d, a, km, m) in enumerate(ROUTES, 1)],
        ),
        "SeatClasses": frame(
            spark, "SeatClasses", [(i, n, d, Decimal(m)) for i, (n, d, m) in enumerate(CLASSES, 1)]
        ),
        "Trains": frame(spark, "Trains", [(i, *row, True) for i, row in enumerate(TRAINS, 1)]),
        "Coaches": coaches,
        "Seats": seats,
        "Schedules": frame(
            spark,
            "Schedules",
            [
                (i, t, r, at(d), at(a), Decimal(p), "Scheduled", n, CREATED)
                for i, (t, r, d, a, p, n) in enumerate(SCHEDULES, 1)
            ],
        ),
        "RefundPolicies": policies(spark),
    }
    for table in ("Bookings", "Tickets", "Payments", "Notifications"):
        frames[table] = frame(spark, table, [])
    small = ("Stations", "Routes", "Trains", "SeatClasses", "Coaches", "Schedules")
    bounds = {n: 13 for n in small} | {"RefundPolicies": 5}
    return Tables(frames, bounds)
