"""Oracle SQL of listings, views and scalar look-ups, over the wide tables of ``ctes``."""

from __future__ import annotations

from .ctes import with_wide

CARD = "UserID, FullName, Email, PhoneNumber, UserType, IsActive, CreatedAt"
WHEN, WHERE = "DepartureTime, ArrivalTime", "DepartureStation, ArrivalStation"
PASSENGER = "PassengerName, PassengerIDNumber, PassengerPhone"
ON_TRIP = "booked INNER JOIN trips USING (ScheduleID)"


def like(text: str, *columns: str) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{text}')" for c in columns) + ")"


def ahead(as_of: str) -> str:
    return f"Status = 'Scheduled' AND DepartureTime > TIMESTAMP '{as_of}'"


def refund(as_of: str, departure: str = "DepartureTime") -> str:
    """The share given back: of the policies that are met, the one with the most hours."""
    return f"""coalesce(list_extract(list_transform(list_filter(
    (SELECT list(p ORDER BY p.HoursBeforeDeparture DESC) FROM RefundPolicies p),
    lambda x: x.HoursBeforeDeparture <= date_diff('hour', TIMESTAMP '{as_of}', {departure})),
    lambda x: x.RefundPercentage), 1), 0)::DECIMAL(5,2)"""


def users(where: str = "true") -> str:
    return f"""
SELECT {CARD}, coalesce(n, 0) AS TotalBookings, coalesce(spent, 0)::DECIMAL(28,2) AS TotalSpent,
  latest AS LastBookingDate FROM Users LEFT JOIN per_user USING (UserID) WHERE {where}"""


def stations(where: str = "true") -> str:
    return f"""
SELECT Stations.*, coalesce(leaving, 0) AS DepartureRoutes, coalesce(coming, 0) AS ArrivalRoutes
FROM Stations
LEFT JOIN (SELECT DepartureStationID AS StationID, count(*) AS leaving FROM Routes GROUP BY 1) USING (StationID)
LEFT JOIN (SELECT ArrivalStationID AS StationID, count(*) AS coming FROM Routes GROUP BY 1) USING (StationID)
WHERE {where}"""


def trains(as_of: str, where: str = "true", once: bool = False) -> str:
    """Seats are repeated for each trip ahead, as the listing states them, or stated once."""
    times = "1" if once else "greatest(trips, 1)"
    return f"""
SELECT Trains.*, coalesce(coaches, 0) AS ConfiguredCoaches, (seats * {times})::BIGINT AS TotalSeats,
  coalesce(trips, 0) AS UpcomingSchedules
FROM Trains
LEFT JOIN (SELECT TrainID, count(*) AS coaches, sum(TotalSeats) AS seats FROM Coaches GROUP BY 1) USING (TrainID)
LEFT JOIN (SELECT TrainID, count(*) AS trips FROM Schedules WHERE {ahead(as_of)} GROUP BY 1) USING (TrainID)
WHERE {where}"""


def search(seat_class: int | None) -> str:
    """A row for each coach of the train, or one without a class if it has none."""
    chosen = "" if seat_class is None else f" WHERE SeatClassID = {seat_class}"
    price = "BasePrice" if seat_class is None else f"""coalesce((BasePrice * (
    SELECT any_value(PriceMultiplier) FROM SeatClasses{chosen}))::DECIMAL(10,2), 0)::DECIMAL(10,2)"""
    return f"""
SELECT ScheduleID, TrainCode, TrainName, {WHERE}, {WHEN},
  date_diff('minute', DepartureTime, ArrivalTime)::INTEGER AS TravelTimeMinutes, {price} AS Price,
  AvailableSeats, ClassName AS SeatClass
FROM trips LEFT JOIN (SELECT TrainID, ClassName FROM Coaches INNER JOIN SeatClasses USING (SeatClassID)
  {chosen}) USING (TrainID)
WHERE AvailableSeats > 0 AND Status = 'Scheduled'"""


def seat_rows(grid: str, columns: str, taken: str, free: str) -> str:
    """Seats of ``grid``, once for every ticket that the seat ever had (once at least): as
    taken for the active tickets of the schedule, as free for the rest."""
    return f"""
SELECT * FROM (WITH grid AS ({grid}),
ever AS (SELECT SeatID, count(*) AS tickets FROM Tickets GROUP BY SeatID),
active AS (SELECT SeatID, ScheduleID, count(*) AS sold FROM Tickets INNER JOIN booked USING (BookingID)
  WHERE BookingStatus = 'Active' GROUP BY ALL),
counted AS (SELECT grid.*, greatest(coalesce(tickets, 0), 1) AS every, coalesce(sold, 0) AS sold
  FROM grid LEFT JOIN ever USING (SeatID) LEFT JOIN active USING (SeatID, ScheduleID))
SELECT {columns.format(status=taken)} FROM (SELECT *, unnest(range(sold)) FROM counted)
UNION ALL
SELECT {columns.format(status=free)} FROM (SELECT *, unnest(range(every - sold)) FROM counted))"""


def seat_map(schedule: int, where: str = "true") -> str:
    price = f"(SELECT any_value(BasePrice) FROM Schedules WHERE ScheduleID = {schedule})"
    return seat_rows(
        f"SELECT *, {schedule}::BIGINT AS ScheduleID FROM places WHERE {where}",
        "SeatID, SeatNumber, SeatType, ClassName, {status}::INTEGER AS IsAvailable, "
        f"coalesce(({price} * PriceMultiplier)::DECIMAL(10,2), 0)::DECIMAL(10,2) AS Price",
        "0", "1",
    )


def customer_bookings(where: str = "true") -> str:
    return f"""
SELECT BookingID, BookingCode, BookingDate, FullName AS CustomerName, Email, PhoneNumber, {WHEN},
  TrainCode, {WHERE}, TotalAmount, PaymentStatus, BookingStatus, nt AS NumberOfTickets
FROM {ON_TRIP} INNER JOIN Users USING (UserID) WHERE {where}"""


def tickets(columns: str) -> str:
    return f"""
SELECT {columns} FROM places INNER JOIN Tickets USING (SeatID)
INNER JOIN (SELECT BookingID, BookingCode, trips.* EXCLUDE (TrainID) FROM {ON_TRIP}) USING (BookingID)"""


def listing_sql(as_of: str) -> dict[str, str]:
    then = "1998-06-15 09:30:00"
    sql = {
        "l01_users": users(),
        "l01_users_filtered": users(
            "UserType = 'Customer' AND IsActive AND regexp_matches("
            "lower(concat_ws(chr(10), FullName, Email, PhoneNumber)), 'customer.*1')"
        ),
        "l02a_user_cards": f"SELECT {CARD} FROM Users",
        "l02b_user_bookings": f"""
SELECT BookingID, BookingCode, BookingDate, TrainCode, {WHERE}, DepartureTime, TotalAmount,
  PaymentStatus, BookingStatus FROM {ON_TRIP}""",
        "l03_stations": stations(),
        "l03_stations_filtered": stations(
            f"IsActive AND {like('nation_1', 'StationName', 'StationCode', 'City')}"
        ),
        "l04_trains": trains(as_of),
        "l04_trains_once": trains(as_of, once=True),
        "l04_trains_filtered": trains(as_of, "TrainType = 'SE' AND IsActive"),
        "l05_routes": f"""
SELECT RouteID, RouteCode, from_id AS DepartureStationID, DepartureStation,
  from_code AS DepartureStationCode, to_id AS ArrivalStationID, ArrivalStation,
  to_code AS ArrivalStationCode, Distance, EstimatedDuration, IsActive,
  (SELECT count(*) FROM Schedules WHERE {ahead(as_of)} AND Schedules.RouteID = ends.RouteID)
    AS UpcomingSchedules
FROM ends WHERE IsActive""",
        "l06_schedules": f"""
SELECT ScheduleID, {WHEN}, TrainCode, TrainName, {WHERE}, Distance, BasePrice, AvailableSeats, Status,
  coalesce(n, 0) AS TotalBookings, coalesce(paid, 0)::DECIMAL(28,2) AS Revenue
FROM trips LEFT JOIN per_trip USING (ScheduleID)""",
        "l07_bookings": customer_bookings(),
        "l07_bookings_filtered": customer_bookings(
            "(BookingStatus, PaymentStatus) = ('Active', 'Paid') AND day >= DATE '1996-01-01'"
            f" AND day < DATE '2000-07-01' AND {like('bk199', 'BookingCode', 'FullName', 'Email')}"
        ),
        "l08_user_notifications": """
SELECT NotificationID, NotificationType, Title, Message, IsRead, SentAt, ScheduledFor,
  (SELECT any_value(BookingCode) FROM Bookings WHERE Bookings.BookingID = Notifications.BookingID)
    AS BookingCode FROM Notifications""",
        "l09_user_tickets": tickets(
            f"TicketID, {PASSENGER}, TicketPrice, TicketStatus, BookingCode, {WHEN}, {WHERE},"
            " TrainName, ClassName AS SeatClass, CoachNumber, SeatNumber"
        ),
        "l10_user_payments": """
SELECT Payments.* EXCLUDE (BookingID), BookingCode FROM Payments
INNER JOIN (SELECT BookingID, BookingCode FROM Bookings) USING (BookingID)""",
        "l11_booking_history": f"""
SELECT BookingID, BookingCode, BookingDate, TrainCode, TrainName, {WHERE}, {WHEN}, TotalAmount,
  PaymentStatus, BookingStatus, nt AS NumberOfTickets FROM {ON_TRIP}""",
        "l12a_booking_headers": f"""
SELECT BookingID, BookingCode, BookingDate, TotalAmount, PaymentStatus, BookingStatus,
  FullName AS CustomerName, Email, PhoneNumber, TrainCode, TrainName, DepartureStation,
  from_code AS DepartureStationCode, ArrivalStation, to_code AS ArrivalStationCode, {WHEN},
  Distance, EstimatedDuration, {refund(then)} AS RefundPercentage
FROM {ON_TRIP} INNER JOIN Users USING (UserID)""",
        "l12b_booking_tickets": f"""
SELECT TicketID, {PASSENGER}, CoachNumber, SeatNumber, SeatType, ClassName AS SeatClass,
  TicketPrice, TicketStatus FROM places INNER JOIN Tickets USING (SeatID)""",
        "l12c_booking_payments": """
SELECT Payments.* EXCLUDE (BookingID, ResponseCode, ResponseMessage) FROM Payments""",
        "l13_search_trips": search(None),
        "l13_search_trips_by_class": search(3),
        "l14_seat_map": seat_map(725),
        "l14_seat_map_of_coach": seat_map(725, "CoachID = 115"),
        "v01_available_schedules": f"""
SELECT ScheduleID, {WHEN}, TrainCode, TrainName, {WHERE}, Distance, EstimatedDuration, BasePrice,
  AvailableSeats, Status FROM trips WHERE {ahead(as_of)}""",
        "v02_customer_bookings": customer_bookings(),
        "v03_ticket_details": tickets(
            f"TicketID, BookingCode, {PASSENGER}, TrainCode, {WHERE}, {WHEN}, CoachNumber,"
            " SeatNumber, ClassName AS SeatClass, TicketPrice, TicketStatus"
        ),
        "v04_seat_availability": seat_rows(
            "SELECT ScheduleID, TrainCode, places.* FROM trips INNER JOIN places USING (TrainID)"
            " WHERE Status = 'Scheduled'",
            "ScheduleID, TrainCode, CoachNumber, ClassName, SeatID, SeatNumber, SeatType,"
            " {status} AS SeatStatus",
            "'Booked'", "'Available'",
        ),
        "v04_seat_status_counts": f"""
SELECT ScheduleID, SeatID, SeatStatus, count(*) AS Tickets FROM ({seat_rows(
    "SELECT ScheduleID, places.* FROM trips INNER JOIN places USING (TrainID) WHERE Status = 'Scheduled'",
    "ScheduleID, SeatID, {status} AS SeatStatus", "'Booked'", "'Available'")}) GROUP BY ALL""",
        "v05_payment_history": f"""
SELECT PaymentID, TransactionID, BookingCode, CustomerName, PaymentMethod, Amount, PaymentDate,
  Payments.PaymentStatus, TrainCode, {WHERE}
FROM Payments INNER JOIN ({customer_bookings()}) USING (BookingID)""",
        "v06_unread_notifications": """
SELECT NotificationID, UserID, FullName, Email, NotificationType, Title, Message, SentAt, BookingCode
FROM (SELECT * FROM Notifications WHERE NOT IsRead) INNER JOIN Users USING (UserID)
LEFT JOIN (SELECT BookingID, BookingCode FROM Bookings) USING (BookingID)""",
        "f01_price_list": """
SELECT ScheduleID, SeatClassID, (BasePrice * PriceMultiplier)::DECIMAL(10,2) AS Price
FROM Schedules INNER JOIN (SELECT TrainID, unnest(list_distinct(list(SeatClassID))) AS SeatClassID
  FROM Coaches GROUP BY TrainID) USING (TrainID) INNER JOIN SeatClasses USING (SeatClassID)""",
        "f01_ticket_price": """
SELECT TicketID, ScheduleID, SeatClassID,
  coalesce((BasePrice * PriceMultiplier)::DECIMAL(10,2), 0)::DECIMAL(10,2) AS Price
FROM places INNER JOIN Tickets USING (SeatID) INNER JOIN booked USING (BookingID)
LEFT JOIN (SELECT ScheduleID, BasePrice FROM Schedules) USING (ScheduleID)""",
        "f02_refund_percentage": f"""
SELECT BookingID, {refund(then)} AS RefundPercentage
FROM Bookings LEFT JOIN (SELECT ScheduleID, DepartureTime FROM Schedules) USING (ScheduleID)""",
        "f03_travel_time": """
SELECT ScheduleID, DepartureTime, ArrivalTime, format('{} giờ {} phút',
  date_diff('hour', DepartureTime, ArrivalTime), date_diff('minute', DepartureTime, ArrivalTime) % 60)
  AS TravelTime FROM Schedules""",
        "f04_seat_available": """
SELECT * FROM (WITH asked AS (SELECT DISTINCT SeatID, ScheduleID FROM Tickets INNER JOIN Bookings USING (BookingID)),
taken AS (SELECT DISTINCT SeatID, ScheduleID, true AS held FROM Tickets INNER JOIN Bookings USING (BookingID)
  WHERE (BookingStatus, TicketStatus) = ('Active', 'Valid'))
SELECT SeatID, ScheduleID, if(held, 0, 1)::INTEGER AS IsAvailable
FROM asked LEFT JOIN taken USING (SeatID, ScheduleID))""",
        "f05_route_names": """
SELECT RouteID, concat(DepartureStation, ' → ', ArrivalStation) AS RouteName FROM ends""",
        "f06_admins": """
SELECT UserID, IsActive AND UserType = 'Admin' AS IsAdmin FROM Users""",
    }
    return {name: with_wide(body, as_of) for name, body in sql.items()}
