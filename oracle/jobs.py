"""Oracle SQL of the deterministic outputs of the batch jobs."""

from __future__ import annotations

from .ctes import with_tables
from .listings import refund


JOB_AS_OF = "1998-06-15 09:30:00"
REMIND_AS_OF = "1998-07-18 12:00:00"
EARLY = "1990-01-01 00:00:00"
CANCEL = """
commands AS (
  SELECT o_orderkey * 4 + 1 AS request_id, o_orderkey AS booking_id, 'plan changed' AS reason,
    NULL::BIGINT AS admin_id FROM orders
  UNION ALL SELECT -c_custkey - 1, -c_custkey - 1, 'mistake', NULL FROM customer
  UNION ALL SELECT event_id * 4 + CASE WHEN value < 50 THEN 0 ELSE 2 END, event_id, event_type,
    user_id FROM events),
admin AS (SELECT UserID FROM Users WHERE UserType = 'Admin' AND IsActive),
judged AS (
  SELECT c.*, b.BookingStatus, b.ScheduleID, s.DepartureTime,
    date_diff('hour', TIMESTAMP '{as_of}', s.DepartureTime) AS hours,
    c.admin_id IS NULL OR c.admin_id IN (SELECT UserID FROM admin) AS may
  FROM commands c LEFT JOIN (Bookings b JOIN Schedules s ON b.ScheduleID = s.ScheduleID)
    ON c.booking_id = b.BookingID),
good AS (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY request_id) AS nth FROM judged
  WHERE may AND BookingStatus = 'Active' AND hours >= 0),
hit AS (
  SELECT b.*, g.request_id, g.reason, {refund} AS pct
  FROM good g JOIN Bookings b ON g.booking_id = b.BookingID
  JOIN Schedules s ON b.ScheduleID = s.ScheduleID WHERE g.nth = 1)
""".replace("{refund}", refund("{as_of}", "s.DepartureTime"))
CANCEL_SCHED = """
commands AS (
  SELECT ScheduleID * 2 AS request_id, ScheduleID,
    CASE WHEN ScheduleID % 3 <> 0 THEN 'track work ' || ScheduleID END AS reason,
    CASE WHEN ScheduleID % 2 = 0 THEN NULL WHEN ScheduleID % 3 = 0 THEN 100 ELSE 101 END
      AS admin_id FROM Schedules
  UNION ALL SELECT ScheduleID * 2 + 1, ScheduleID, 'storm', NULL FROM Schedules),
allowed AS (SELECT * FROM commands WHERE admin_id IS NULL
  OR admin_id IN (SELECT UserID FROM Users WHERE UserType = 'Admin' AND IsActive)),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ScheduleID
  ORDER BY request_id) AS nth FROM allowed) WHERE nth = 1)
"""
PAY = """
attempts AS (
  SELECT o_orderkey * 4 + 1 AS request_id, o_orderkey AS booking_id, 'A' || o_orderkey AS txn,
    CASE WHEN o_orderkey % 5 = 0 THEN '05' ELSE '00' END AS code FROM orders
  UNION ALL SELECT -c_custkey - 1, -c_custkey - 1, 'U' || c_custkey, '00' FROM customer
  UNION ALL SELECT event_id * 4 + CASE WHEN value < 50 THEN 0 ELSE 2 END, event_id,
    'E' || event_id, CASE WHEN event_type = 'error' THEN '12' ELSE '00' END FROM events),
good AS (
  SELECT a.*, b.UserID, b.BookingCode, trunc(b.TotalAmount)::DECIMAL(10,2) AS amount,
    row_number() OVER (PARTITION BY booking_id ORDER BY request_id DESC) AS back
  FROM attempts a JOIN Bookings b ON a.booking_id = b.BookingID
  WHERE b.BookingStatus = 'Active')
"""
NEW_USERS = """
cand AS (
  SELECT s_suppkey * 2 AS request_id,
    CASE s_suppkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 101 END AS admin_id, s_name AS FullName,
    lower(s_name) || '@example.com' AS Email,
    '08' || lpad(s_suppkey::VARCHAR, greatest(8, length(s_suppkey::VARCHAR))::INTEGER, '0')
      AS PhoneNumber,
    'secret' || s_suppkey AS password, 'Staff' AS UserType FROM supplier
  UNION ALL SELECT c_custkey * 2 + 1, NULL, c_name,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'new.' END || lower(c_name) || '@example.com',
    '07' || lpad((c_custkey // 2)::VARCHAR,
      greatest(8, length((c_custkey // 2)::VARCHAR))::INTEGER, '0'),
    'password' || c_custkey, 'Customer' FROM customer),
judged AS (
  SELECT c.*, CASE
    WHEN admin_id IS NOT NULL AND admin_id NOT IN
      (SELECT UserID FROM Users WHERE UserType = 'Admin' AND IsActive)
      THEN 'Insufficient permissions'
    WHEN Email IN (SELECT Email FROM Users) THEN 'Email đã tồn tại trong hệ thống'
    WHEN PhoneNumber IN (SELECT PhoneNumber FROM Users)
      THEN 'Số điện thoại đã tồn tại trong hệ thống'
    WHEN admin_id IS NULL AND length(password) < 8
      THEN 'Password must have at least 8 characters' END AS reason FROM cand c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY PhoneNumber ORDER BY request_id) AS nth
  FROM judged WHERE reason IS NULL)
"""
NEW_SCHEDULES = """
cand AS (
  SELECT s_suppkey AS request_id, s_suppkey AS TrainID, s_suppkey % 60 AS RouteID,
    TIMESTAMP '2002-01-01' + to_days((s_suppkey % 365)::INTEGER) AS DepartureTime,
    TIMESTAMP '2002-01-01' + to_days((s_suppkey % 365)::INTEGER)
      + to_hours(CASE WHEN s_suppkey % 7 = 0 THEN -1 ELSE 5 END) AS ArrivalTime FROM supplier),
judged AS (
  SELECT c.*, CASE WHEN ArrivalTime <= DepartureTime THEN 'arrival is not after departure'
    WHEN RouteID NOT IN (SELECT RouteID FROM Routes) THEN 'unknown RouteID' END AS reason
  FROM cand c)
"""
BOOK = """
asked AS (
  SELECT o_orderkey AS request_id, o_custkey AS UserID,
    ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT * 10 + o_custkey % 10
      AS sched, [o_orderkey % 40, (o_custkey // 10) % 40] AS seats FROM orders),
held AS (SELECT DISTINCT b.ScheduleID AS sched, tk.SeatID FROM Tickets tk
  JOIN Bookings b ON tk.BookingID = b.BookingID
  WHERE b.BookingStatus = 'Active' AND tk.TicketStatus = 'Valid'),
clash AS (SELECT DISTINCT a.request_id FROM asked a JOIN held h ON h.sched = a.sched
  AND (h.SeatID = a.seats[1] OR h.SeatID = a.seats[2])),
judged AS (
  SELECT a.*, s.BasePrice, CASE WHEN s.ScheduleID IS NULL THEN 50001
    WHEN a.seats[1] = a.seats[2] THEN 50003
    WHEN a.request_id IN (SELECT request_id FROM clash) THEN 50003 END AS code
  FROM asked a LEFT JOIN Schedules s ON s.ScheduleID = a.sched AND s.Status = 'Scheduled'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sched ORDER BY request_id) AS nth
  FROM judged WHERE code IS NULL),
walk AS (
  SELECT DISTINCT sched, 0::BIGINT AS nth, []::BIGINT[] AS taken, NULL::BIGINT AS request_id,
    false AS won FROM ranked
  UNION ALL
  SELECT w.sched, r.nth, CASE WHEN list_has_any(w.taken, r.seats) THEN w.taken
      ELSE list_concat(w.taken, r.seats) END, r.request_id, NOT list_has_any(w.taken, r.seats)
  FROM walk w JOIN ranked r ON r.sched = w.sched AND r.nth = w.nth + 1),
placed AS (
  SELECT r.*, unnest([1, 2]) AS pos FROM ranked r
  WHERE r.request_id IN (SELECT request_id FROM walk WHERE won)),
sold AS (
  SELECT p.request_id, p.UserID, p.sched, p.pos, p.seats[p.pos] AS SeatID,
    CASE p.pos WHEN 1 THEN 'An' ELSE 'Binh' END AS PassengerName,
    (p.BasePrice * sc.PriceMultiplier)::DECIMAL(10,2) AS price
  FROM placed p JOIN Seats st ON st.SeatID = p.seats[p.pos]
  JOIN Coaches c ON st.CoachID = c.CoachID JOIN SeatClasses sc ON c.SeatClassID = sc.SeatClassID),
new AS (
  SELECT request_id, UserID, sched, SUM(price)::DECIMAL(10,2) AS total,
    row_number() OVER (ORDER BY request_id) AS n,
    (SELECT max(BookingID) FROM Bookings) + row_number() OVER (ORDER BY request_id) AS BookingID
  FROM sold GROUP BY request_id, UserID, sched)
"""
CHECKED = """
places AS (SELECT TrainID, list(SeatID ORDER BY SeatID) AS own
  FROM Seats JOIN Coaches USING (CoachID) GROUP BY TrainID),
orders_of AS (
  SELECT o.k AS request_id, o.c, if(o.k % 31 <> 9, o.trip, NULL) AS sched, p.own,
    if(o.k % 13 = 5, -o.c, if(o.k % 37 <> 1, o.c, NULL)) AS UserID,
    if(o.k % 7 = 2, 'Cheque', if(o.k % 23 = 8, NULL, 'VNPay')) AS method
  FROM (SELECT o_orderkey AS k, o_custkey AS c,
      ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT * 10 + o_custkey % 10 AS trip
    FROM orders) o LEFT JOIN Schedules s ON s.ScheduleID = o.trip LEFT JOIN places p USING (TrainID)),
asked AS (
  SELECT request_id, UserID, sched, method,
    CASE WHEN request_id % 29 = 7 THEN []::BIGINT[] ELSE list_concat([
      CASE WHEN request_id % 19 = 6 THEN request_id + 1000000000
        WHEN request_id % 3 = 0 THEN request_id % 40 ELSE own[request_id % len(own) + 1] END,
      if(request_id % 17 = 4, NULL, own[c // 10 % len(own) + 1])],
      if(request_id % 5 = 1, [own[(request_id + c) % len(own) + 1]], []::BIGINT[])) END AS seats,
    CASE WHEN request_id % 29 = 7 THEN []::VARCHAR[] WHEN request_id % 11 = 3 THEN ['An']
      WHEN request_id % 5 = 1 THEN ['An', 'Binh', 'Chi'] ELSE ['An', 'Binh'] END AS names
  FROM orders_of),
held AS (SELECT DISTINCT b.ScheduleID AS sched, tk.SeatID FROM Tickets tk
  JOIN Bookings b ON tk.BookingID = b.BookingID
  WHERE b.BookingStatus = 'Active' AND tk.TicketStatus = 'Valid'),
singles AS (
  SELECT request_id, sched, generate_subscripts(seats, 1) AS pos, unnest(seats) AS SeatID FROM asked),
seen AS (
  SELECT x.request_id, bool_or(st.SeatID IS NULL) AS unknown,
    bool_or(c.TrainID IS DISTINCT FROM s.TrainID) AS elsewhere, bool_or(h.SeatID IS NOT NULL) AS taken
  FROM singles x LEFT JOIN Seats st ON st.SeatID = x.SeatID LEFT JOIN Coaches c ON c.CoachID = st.CoachID
  LEFT JOIN Schedules s ON s.ScheduleID = x.sched
  LEFT JOIN held h ON h.sched = x.sched AND h.SeatID = x.SeatID GROUP BY x.request_id),
judged AS (
  SELECT a.*, s.BasePrice, CASE
    WHEN s.ScheduleID IS NULL THEN 'trip'
    WHEN date_diff('hour', TIMESTAMP '1997-01-09 08:30:00', s.DepartureTime) < 2 THEN 'late'
    WHEN a.UserID IS NOT NULL AND a.UserID NOT IN (SELECT UserID FROM Users) THEN 'user'
    WHEN len(a.seats) <> len(a.names) THEN 'lists'
    WHEN len(list_filter(a.seats, lambda x: x IS NULL)) > 0 THEN 'seat'
    WHEN len(list_distinct(a.seats)) < len(a.seats) THEN 'taken'
    WHEN a.method = 'Cheque' THEN 'method'
    WHEN v.unknown THEN 'seat' WHEN v.elsewhere THEN 'train' WHEN v.taken THEN 'taken' END AS fault
  FROM asked a LEFT JOIN Schedules s ON s.ScheduleID = a.sched AND s.Status = 'Scheduled'
  LEFT JOIN seen v ON v.request_id = a.request_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sched ORDER BY request_id) AS nth
  FROM judged WHERE fault IS NULL),
walk AS (
  SELECT DISTINCT sched, 0::BIGINT AS nth, []::BIGINT[] AS taken, NULL::BIGINT AS request_id,
    false AS won FROM ranked
  UNION ALL
  SELECT w.sched, r.nth, CASE WHEN list_has_any(w.taken, r.seats) THEN w.taken
      ELSE list_concat(w.taken, r.seats) END, r.request_id, NOT list_has_any(w.taken, r.seats)
  FROM walk w JOIN ranked r ON r.sched = w.sched AND r.nth = w.nth + 1),
won AS (
  SELECT r.*, row_number() OVER (ORDER BY request_id) AS n,
    (SELECT max(BookingID) FROM Bookings) + row_number() OVER (ORDER BY request_id) AS BookingID
  FROM ranked r WHERE request_id IN (SELECT request_id FROM walk WHERE won)),
sold AS (
  SELECT w.request_id, w.BookingID, w.sched, x.pos, x.SeatID, w.names[x.pos] AS PassengerName,
    (w.BasePrice * sc.PriceMultiplier)::DECIMAL(10,2) AS price
  FROM won w JOIN singles x ON x.request_id = w.request_id JOIN Seats st ON st.SeatID = x.SeatID
  JOIN Coaches c ON st.CoachID = c.CoachID JOIN SeatClasses sc ON c.SeatClassID = sc.SeatClassID),
new AS (
  SELECT w.*, coalesce(t.total, 0)::DECIMAL(10,2) AS total FROM won w
  LEFT JOIN (SELECT request_id, sum(price) AS total FROM sold GROUP BY request_id) t USING (request_id))
"""
CLAIMS = """
claims AS (
  SELECT c.*, CASE WHEN coalesce(s.Status, '') <> 'Scheduled' THEN 50001 END::INTEGER AS code,
    CASE WHEN coalesce(s.Status, '') <> 'Scheduled' THEN 'Lịch trình không tồn tại hoặc đã bị hủy.'
      WHEN ClaimedAt >= s.DepartureTime
      THEN 'Không thể đặt vé cho chuyến tàu khởi hành trong vòng 2 giờ' END AS reason
  FROM (SELECT ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT * 10
      + o_custkey % 10 AS ScheduleID, o_orderkey % 40 AS SeatID, o_orderkey AS BookingID,
      o_orderdate::TIMESTAMP AS ClaimedAt FROM orders) c
  LEFT JOIN Schedules s USING (ScheduleID))
"""
NO_PAYMENT = "Không tồn tại payment, kiểm tra lại thông tin booking!"
NEW_MASTER = {
    "Stations": """
asked AS (
  SELECT *, CASE WHEN StationCode IN (SELECT StationCode FROM Stations) THEN 'StationCode exists already'
    WHEN length(StationName) > 100 THEN 'StationName is too long'
    WHEN City IS NULL THEN 'City is missing' END AS reason
  FROM (SELECT n_nationkey::BIGINT * 2 AS request_id,
      if(n_nationkey % 4 = 0, 'N', 'S') || n_nationkey AS StationCode, 'New ' || n_name AS StationName,
      if(n_nationkey % 5 <> 0, n_name, NULL) AS City, 'West' AS Province, NULL::VARCHAR AS Address,
      true AS IsActive FROM nation
    UNION ALL SELECT n_nationkey::BIGINT * 2 + 1, 'S' || n_nationkey,
      if(n_nationkey % 3 = 0, repeat('x', 101), n_name), n_name, 'East', NULL, true FROM nation))""",
    "Trains": """
asked AS (
  SELECT *, CASE WHEN TrainCode IN (SELECT TrainCode FROM Trains) THEN 'TrainCode exists already'
    WHEN TotalCoaches IS NULL THEN 'TotalCoaches is missing' END AS reason
  FROM (SELECT s_suppkey AS request_id,
    if(s_suppkey % 5 = 0, 'T' || s_suppkey, 'X' || (s_suppkey // 2)) AS TrainCode, s_name AS TrainName,
    'SE' AS TrainType, if(s_suppkey % 7 <> 0, 8, NULL)::INTEGER AS TotalCoaches, true AS IsActive
    FROM supplier))""",
    "Routes": """
asked AS (
  SELECT *, CASE WHEN ArrivalStationID = DepartureStationID
      THEN 'Departure and arrival stations must be different'
    WHEN ArrivalStationID >= 100 THEN 'unknown ArrivalStationID' END AS reason
  FROM (SELECT n::BIGINT AS request_id, 'R' || n AS RouteCode, n::BIGINT AS DepartureStationID,
    (CASE n % 5 WHEN 0 THEN n WHEN 1 THEN n + 100 ELSE (n + 1) % 25 END)::BIGINT AS ArrivalStationID,
    100::DECIMAL(8,2) AS Distance, 60 AS EstimatedDuration, true AS IsActive
    FROM (SELECT n_nationkey AS n FROM nation)))""",
}
USER_EDITS = """
edits AS (
  SELECT event_id AS request_id, user_id AS UserID, user_id IN (SELECT UserID FROM Users) AS known,
    CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN repeat('x', 101) ELSE 'Name ' || event_id END AS FullName,
    if(event_id % 11 = 3, 'shared' || (event_id // 50), 'u' || event_id) || '@example.org' AS Email,
    event_id % 11 AS event_kind, if(event_id % 11 = 4, '0900000001',
      '06' || lpad(event_id::VARCHAR, greatest(8, length(event_id::VARCHAR))::INTEGER, '0')) AS PhoneNumber
  FROM events),
judged AS (
  SELECT *, CASE WHEN NOT known THEN NULL WHEN FullName IS NULL THEN 'FullName is missing'
    WHEN length(FullName) > 100 THEN 'FullName is too long'
    END AS reason FROM edits),
-- one by one: only the shared addresses and the one number are asked for by several users
able AS (SELECT *, event_kind NOT IN (3, 4) AS alone FROM judged WHERE reason IS NULL AND known),
later AS (SELECT *, min(CASE WHEN alone THEN request_id END) OVER (PARTITION BY UserID ORDER BY request_id
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_alone FROM able),
line AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY request_id) AS n, if(event_kind = 3, Email, PhoneNumber) AS item
  FROM later WHERE NOT alone),
steps(n, held, request_id, at_start) AS (
  SELECT 0::BIGINT, list_value({'k': 1::BIGINT, 'item': '0900000001', 'begin': 0::BIGINT, 'next': (SELECT min(request_id)
    FROM able WHERE UserID = 1 AND alone)}), NULL::BIGINT, NULL::BOOLEAN
  UNION ALL
  SELECT n, CASE WHEN len(rivals) > 0 THEN held ELSE list_append(list_filter(held, lambda h: h.k <> UserID),
      {'k': UserID, 'item': item, 'begin': coalesce(kept[1].begin, req), 'next': next_alone}) END,
    CASE WHEN len(rivals) > 0 THEN req END, CASE WHEN len(rivals) > 0 THEN rivals[1].begin = 0 END
  FROM (SELECT l.n, s.held, l.request_id AS req, l.UserID, l.item, l.next_alone,
      list_filter(s.held, lambda h: h.item = l.item AND h.k <> l.UserID AND coalesce(h.next > l.request_id, true)) AS rivals,
      list_filter(s.held, lambda h: h.item = l.item AND h.k = l.UserID AND coalesce(h.next > l.request_id, true)) AS kept
    FROM steps s JOIN line l ON l.n = s.n + 1)),
sound AS (SELECT able.*, steps.request_id IS NOT NULL AS late, at_start
  FROM able LEFT JOIN steps USING (request_id))
"""
B_COLS = "b.BookingID, b.BookingCode, b.UserID, b.ScheduleID, b.BookingDate, b.TotalAmount"
T_COLS = """tk.TicketID, tk.BookingID, tk.SeatID, tk.PassengerName, tk.PassengerIDNumber,
  tk.PassengerPhone, tk.TicketPrice"""
S_COLS = """s.ScheduleID, s.TrainID, s.RouteID, s.DepartureTime, s.ArrivalTime, s.BasePrice,
  s.Status, {seats} AS AvailableSeats, s.CreatedAt"""


def _notice(kind: str, title: str, text: str, as_of: str, later: str = "NULL::TIMESTAMP") -> str:
    return f"""'{kind}' AS NotificationType, {title} AS Title, {text} AS Message,
  false AS IsRead, TIMESTAMP '{as_of}' AS SentAt, {later} AS ScheduledFor"""


def _payment_notice(amount: str, code: str, ok: str, as_of: str) -> str:
    number = f"format('{{:,}}', round({amount}, 0)::BIGINT)"
    return _notice(
        "Payment",
        f"CASE WHEN {ok} THEN 'Thanh toán thành công' ELSE 'Thanh toán thất bại' END",
        f"""CASE WHEN {ok} THEN 'Bạn đã thanh toán thành công '
    ELSE 'Bạn đã thanh toán thất bại ' END || {number} || 'đ cho mã đặt vé ' || {code}""",
        as_of,
    )


def _changed_users() -> str:
    return """
SELECT u.UserID, CASE WHEN l.request_id IS NULL THEN u.FullName ELSE l.FullName END AS FullName,
  CASE WHEN l.request_id IS NULL THEN u.Email ELSE l.Email END AS Email,
  CASE WHEN l.request_id IS NULL THEN u.PhoneNumber ELSE l.PhoneNumber END AS PhoneNumber,
  u.UserType, u.IsActive, u.CreatedAt
FROM Users u LEFT JOIN (
  SELECT event_id AS request_id, user_id AS UserID, 'Name ' || event_id AS FullName,
    CASE WHEN event_id % 2 = 0 THEN 'u' || event_id || '@example.org' END AS Email,
    '06' || lpad(event_id::VARCHAR, greatest(8, length(event_id::VARCHAR))::INTEGER, '0')
      AS PhoneNumber,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events) l
ON u.UserID = l.UserID AND l.back = 1"""


def _deleted(table: str, key: str, used: str, users: bool) -> str:
    who = f"CASE {key} % 3 WHEN 0 THEN NULL WHEN 1 THEN 100 ELSE 101 END"
    plain = f"{key} % 3 = 0" if users else "false"
    return f"""
SELECT * REPLACE (false AS IsActive) FROM {table} WHERE {plain} OR
  ({who} IN (SELECT UserID FROM Users WHERE UserType = 'Admin' AND IsActive)
   AND {key} NOT IN ({used}))"""


def job_sql() -> dict[str, str]:
    at = JOB_AS_OF
    cancel, cancel_s = CANCEL.format(as_of=at), CANCEL_SCHED
    out: dict[str, tuple[str, str, str]] = {}

    def add(name: str, body: str, extra: str = "", as_of: str = at) -> None:
        out[name] = (body, as_of, extra)

    add(
        "m02_bookings",
        f"""SELECT {B_COLS}, CASE WHEN b.pct > 0 THEN 'Refunded' ELSE b.PaymentStatus END
  AS PaymentStatus, 'Cancelled' AS BookingStatus, TIMESTAMP '{at}' AS CancelledAt,
  b.reason AS CancellationReason FROM hit b""",
        cancel,
    )
    add("m02_refunds", """SELECT request_id, BookingID AS booking_id, pct AS RefundPercentage
FROM hit""", cancel)
    add(
        "m02_tickets",
        f"""SELECT {T_COLS}, 'Cancelled' AS TicketStatus FROM Tickets tk
WHERE TicketStatus = 'Valid' AND BookingID IN (SELECT BookingID FROM hit)""",
        cancel,
    )
    add(
        "m02_schedules",
        f"""SELECT {S_COLS.format(seats='(s.AvailableSeats + x.n)::INTEGER')} FROM Schedules s
JOIN (SELECT h.ScheduleID, count(*) AS n FROM Tickets tk JOIN hit h ON tk.BookingID = h.BookingID
  WHERE tk.TicketStatus IN ('Valid', 'Cancelled') GROUP BY h.ScheduleID) x
ON s.ScheduleID = x.ScheduleID""",
        cancel,
    )
    text = "'Đặt vé #' || BookingCode || ' đã được hủy. Hoàn tiền: ' || pct::VARCHAR || '%'"
    add(
        "m02_notifications",
        f"""SELECT UserID, BookingID, {_notice('Cancellation', "'Booking Cancelled'", text, at)}
FROM hit""",
        cancel,
    )
    add(
        "m02_rejects",
        """SELECT request_id, code::INTEGER AS code, CASE code
  WHEN 51001 THEN 'Booking không tồn tại.' WHEN 51002 THEN 'Booking không ở trạng thái Active.'
  WHEN 51003 THEN 'Chuyến tàu đã khởi hành, không thể hủy.'
  ELSE 'Insufficient permissions' END AS reason
FROM (SELECT j.request_id, CASE WHEN NOT may THEN NULL WHEN BookingStatus IS NULL THEN 51001
    WHEN BookingStatus <> 'Active' THEN 51002 WHEN hours < 0 THEN 51003 ELSE 51002 END AS code
  FROM judged j WHERE j.request_id NOT IN (SELECT request_id FROM hit))""",
        cancel,
    )
    add(
        "m03_schedules",
        f"""SELECT {S_COLS.format(seats='s.AvailableSeats').replace('s.Status', "'Cancelled' AS Status")}
FROM Schedules s WHERE ScheduleID IN (SELECT ScheduleID FROM firsts)""",
        cancel_s,
    )
    add(
        "m03_bookings",
        f"""SELECT {B_COLS}, b.PaymentStatus, 'Cancelled' AS BookingStatus,
  TIMESTAMP '{at}' AS CancelledAt, f.reason AS CancellationReason
FROM Bookings b JOIN firsts f ON b.ScheduleID = f.ScheduleID WHERE b.BookingStatus = 'Active'""",
        cancel_s,
    )
    text = "'Chuyến tàu ' || t.TrainCode || ' đã bị hủy. Lý do: ' || a.reason"
    add(
        "m03_notifications",
        f"""SELECT b.UserID, b.BookingID,
  {_notice('Cancellation', "'Chuyến tàu bị hủy'", text, at)}
FROM allowed a JOIN Schedules s ON a.ScheduleID = s.ScheduleID
JOIN Trains t ON s.TrainID = t.TrainID JOIN Bookings b ON b.ScheduleID = s.ScheduleID""",
        cancel_s,
    )
    add(
        "m03_rejects",
        """SELECT request_id, NULL::INTEGER AS code, 'Insufficient permissions' AS reason
FROM commands WHERE request_id NOT IN (SELECT request_id FROM allowed)""",
        cancel_s,
    )
    add(
        "m04_payments",
        f"""SELECT p.PaymentID, p.BookingID, p.PaymentMethod, g.txn AS TransactionID,
  g.amount AS Amount, CASE WHEN g.code = '00' THEN TIMESTAMP '{at}' END AS PaymentDate,
  CASE WHEN g.code = '00' THEN 'Success' ELSE 'Failed' END AS PaymentStatus,
  g.code AS ResponseCode,
  CASE WHEN g.code = '00' THEN 'Payment successful' ELSE 'Payment failed' END AS ResponseMessage
FROM good g JOIN Payments p ON p.BookingID = g.booking_id WHERE g.back = 1""",
        PAY,
    )
    add(
        "m04_bookings",
        f"""SELECT {B_COLS}, 'Paid' AS PaymentStatus, b.BookingStatus, b.CancelledAt,
  b.CancellationReason FROM Bookings b
WHERE BookingID IN (SELECT booking_id FROM good WHERE code = '00')""",
        PAY,
    )
    add(
        "m04_tickets",
        f"""SELECT {T_COLS}, 'Valid' AS TicketStatus FROM Tickets tk
WHERE BookingID IN (SELECT booking_id FROM good WHERE code = '00')""",
        PAY,
    )
    add(
        "m04_notifications",
        f"""SELECT UserID, booking_id AS BookingID,
  {_payment_notice('amount', 'BookingCode', "code = '00'", at)} FROM good""",
        PAY,
    )
    add(
        "m04_rejects",
        """SELECT a.request_id, (CASE WHEN b.BookingID IS NULL THEN 54001 ELSE 54002 END)::INTEGER
  AS code, CASE WHEN b.BookingID IS NULL THEN 'Booking không tồn tại.'
  ELSE 'Booking không ở trạng thái Active, không thể thanh toán.' END AS reason
FROM attempts a LEFT JOIN Bookings b ON a.booking_id = b.BookingID
WHERE b.BookingID IS NULL OR b.BookingStatus <> 'Active'""",
        PAY,
    )
    text = """'Chuyến tàu ' || t.TrainCode || ' của bạn sẽ khởi hành lúc '
    || strftime(s.DepartureTime, '%H:%M %d/%m/%Y') || '. Vui lòng có mặt trước 30 phút.'"""
    notice = _notice("Reminder", "'Nhắc nhở chuyến đi'", text, REMIND_AS_OF,
                     "s.DepartureTime - to_hours(2)")
    add(
        "m05_departure_reminders",
        f"""SELECT b.UserID, b.BookingID, {notice}
FROM Bookings b JOIN Schedules s ON b.ScheduleID = s.ScheduleID
JOIN Trains t ON s.TrainID = t.TrainID
WHERE b.BookingStatus = 'Active' AND b.PaymentStatus = 'Paid'
  AND date_diff('hour', TIMESTAMP '{REMIND_AS_OF}', s.DepartureTime) BETWEEN 2 AND 24
  AND NOT EXISTS (SELECT 1 FROM Notifications n WHERE n.BookingID = b.BookingID
    AND n.NotificationType = 'Reminder')""",
    )
    done = f"""
over AS (SELECT ScheduleID FROM Schedules WHERE Status = 'Completed'
  OR (Status = 'Scheduled' AND ArrivalTime < TIMESTAMP '{at}')),
ended AS (SELECT BookingID FROM Bookings WHERE BookingStatus = 'Active'
  AND ScheduleID IN (SELECT ScheduleID FROM over))"""
    add(
        "m06_schedules",
        f"""SELECT {S_COLS.format(seats='s.AvailableSeats').replace('s.Status', "'Completed' AS Status")}
FROM Schedules s WHERE Status = 'Scheduled' AND ArrivalTime < TIMESTAMP '{at}'""",
        as_of=EARLY,
    )
    add(
        "m06_bookings",
        f"""SELECT {B_COLS}, b.PaymentStatus, 'Completed' AS BookingStatus, b.CancelledAt,
  b.CancellationReason FROM Bookings b WHERE BookingID IN (SELECT BookingID FROM ended)""",
        done,
        EARLY,
    )
    add(
        "m06_tickets",
        f"""SELECT {T_COLS}, 'Used' AS TicketStatus FROM Tickets tk WHERE TicketStatus = 'Valid'
AND BookingID IN (SELECT BookingID FROM ended UNION ALL
  SELECT BookingID FROM Bookings WHERE BookingStatus = 'Completed')""",
        done,
        EARLY,
    )
    add(
        "m06_counts",
        f"""SELECT 'schedules' AS TableName, count(*) AS Rows FROM Schedules
  WHERE Status = 'Scheduled' AND ArrivalTime < TIMESTAMP '{at}'
UNION ALL SELECT 'bookings', count(*) FROM ended
UNION ALL SELECT 'tickets', count(*) FROM Tickets WHERE TicketStatus = 'Valid'
AND BookingID IN (SELECT BookingID FROM ended UNION ALL
  SELECT BookingID FROM Bookings WHERE BookingStatus = 'Completed')""",
        done,
        EARLY,
    )
    add(
        "m07_users",
        f"""SELECT (SELECT max(UserID) FROM Users) + row_number() OVER (ORDER BY request_id)
    AS UserID, FullName, Email, PhoneNumber, sha256(password) AS PasswordHex, UserType,
  true AS IsActive, TIMESTAMP '{at}' AS CreatedAt FROM ranked WHERE nth = 1""",
        NEW_USERS,
    )
    add(
        "m07_user_rejects",
        """SELECT request_id, NULL::INTEGER AS code, reason FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT request_id, NULL, 'an earlier row of the batch has this key'
FROM ranked WHERE nth > 1""",
        NEW_USERS,
    )
    add(
        "m07_schedules",
        f"""SELECT (SELECT max(ScheduleID) FROM Schedules)
    + row_number() OVER (ORDER BY request_id) AS ScheduleID, TrainID, RouteID, DepartureTime,
  ArrivalTime, 450000.00::DECIMAL(10,2) AS BasePrice, 'Scheduled' AS Status,
  (SELECT SUM(c.TotalSeats)::INTEGER FROM Coaches c WHERE c.TrainID = j.TrainID)
    AS AvailableSeats, TIMESTAMP '{at}' AS CreatedAt
FROM judged j WHERE reason IS NULL""",
        NEW_SCHEDULES,
    )
    add(
        "m07_schedule_rejects",
        """SELECT request_id, NULL::INTEGER AS code, reason FROM judged
WHERE reason IS NOT NULL""",
        NEW_SCHEDULES,
    )
    add("m08_users", _changed_users())
    add(
        "m08_users_affected",
        """SELECT event_id AS request_id, (CASE WHEN user_id IN (SELECT UserID FROM Users) THEN 1
  ELSE 0 END)::INTEGER AS RowsAffected FROM events""",
    )
    add(
        "m08_schedules",
        """SELECT s.ScheduleID, s.TrainID, s.RouteID, b.BookingDate AS DepartureTime,
  b.BookingDate + to_hours(9) AS ArrivalTime, b.TotalAmount AS BasePrice, 'Delayed' AS Status,
  s.AvailableSeats, s.CreatedAt
FROM Schedules s JOIN (SELECT *, row_number() OVER (PARTITION BY ScheduleID
  ORDER BY BookingID DESC) AS back FROM Bookings) b ON s.ScheduleID = b.ScheduleID AND b.back = 1""",
    )
    active = "SELECT UserID FROM Bookings WHERE BookingStatus = 'Active'"
    add(
        "m09_users",
        _deleted("Users", "UserID", active, True).replace(
            "* REPLACE", "* EXCLUDE (PasswordHex) REPLACE"
        ),
    )
    ends = "SELECT DepartureStationID FROM Routes UNION ALL SELECT ArrivalStationID FROM Routes"
    add("m09_stations", _deleted("Stations", "StationID", ends, False))
    soon = f"""SELECT TrainID FROM Schedules WHERE Status = 'Scheduled'
  AND DepartureTime > TIMESTAMP '2001-07-15 00:00:00'"""
    add("m09_trains", _deleted("Trains", "TrainID", soon, False), as_of="2001-01-01 00:00:00")
    booked = "SELECT ScheduleID FROM Bookings WHERE BookingStatus = 'Active'"
    add("m10_delete_blocked", "SELECT * FROM Schedules")
    add(
        "m10_delete_free",
        f"""SELECT * FROM Schedules WHERE ScheduleID IN ({booked})""",
    )
    add(
        "m11_payment_notices_statement",
        f"""SELECT b.UserID, b.BookingID,
  {_payment_notice('p.Amount', 'b.BookingCode', "p.PaymentStatus = 'Success'", at)}
FROM Payments p JOIN Bookings b ON p.BookingID = b.BookingID
WHERE p.PaymentStatus = 'Success'""",
    )
    add(
        "m11_payment_notices",
        f"""SELECT b.UserID, b.BookingID,
  {_payment_notice('p.Amount', 'b.BookingCode', "p.PaymentStatus = 'Success'", at)}
FROM Payments p JOIN Bookings b ON p.BookingID = b.BookingID
WHERE p.PaymentStatus IN ('Success', 'Failed')""",
    )
    add(
        "m12_generated_seats",
        """SELECT CoachID, lpad(n::VARCHAR, greatest(2, length(n::VARCHAR))::INTEGER, '0')
  AS SeatNumber, CASE WHEN TotalSeats > 50 THEN 'Single' WHEN n % 3 = 1 THEN 'Lower'
  WHEN n % 3 = 2 THEN 'Middle' ELSE 'Upper' END AS SeatType
FROM (SELECT CoachID, TotalSeats, unnest(range(1, TotalSeats + 1)) AS n FROM Coaches)""",
    )
    add(
        "m13_double_booked_seats",
        """SELECT b.ScheduleID, tk.SeatID, count(*) AS Holders
FROM Tickets tk JOIN Bookings b ON tk.BookingID = b.BookingID
WHERE b.BookingStatus = 'Active' AND tk.TicketStatus = 'Valid'
GROUP BY b.ScheduleID, tk.SeatID HAVING count(*) > 1""",
    )
    add(
        "m14_cancelled_tickets",
        f"""SELECT {T_COLS}, 'Cancelled' AS TicketStatus FROM Tickets tk
JOIN Bookings b ON tk.BookingID = b.BookingID
WHERE b.BookingStatus = 'Cancelled' AND tk.TicketStatus <> 'Cancelled'""",
    )
    add(
        "m15_late_bookings",
        f"""SELECT {B_COLS}, b.PaymentStatus, b.BookingStatus, b.CancelledAt,
  b.CancellationReason FROM Bookings b JOIN Schedules s ON b.ScheduleID = s.ScheduleID
WHERE date_diff('hour', TIMESTAMP '{at}', s.DepartureTime) < 2""",
    )
    add("f06_authorised", "SELECT request_id FROM judged WHERE may", cancel)
    add(
        "m01_bookings",
        f"""SELECT BookingID, 'BK19900101' || lpad(n::VARCHAR,
    greatest(5, length(n::VARCHAR))::INTEGER, '0') AS BookingCode, UserID,
  sched AS ScheduleID, TIMESTAMP '{EARLY}' AS BookingDate, total AS TotalAmount,
  'Pending' AS PaymentStatus, 'Active' AS BookingStatus, NULL::TIMESTAMP AS CancelledAt,
  NULL::VARCHAR AS CancellationReason FROM new""",
        BOOK,
        EARLY,
    )
    add(
        "m01_tickets",
        """SELECT (row_number() OVER (ORDER BY n.BookingID, s.pos))::VARCHAR AS TicketID,
  n.BookingID, s.SeatID, s.PassengerName, NULL::VARCHAR AS PassengerIDNumber,
  NULL::VARCHAR AS PassengerPhone, s.price AS TicketPrice, 'Valid' AS TicketStatus
FROM sold s JOIN new n ON s.request_id = n.request_id""",
        BOOK,
        EARLY,
    )
    add(
        "m01_payments",
        f"""SELECT (SELECT max(PaymentID) FROM Payments) + n AS PaymentID, BookingID,
  'VNPay' AS PaymentMethod, NULL::VARCHAR AS TransactionID, total AS Amount,
  TIMESTAMP '{EARLY}' AS PaymentDate, 'Pending' AS PaymentStatus,
  NULL::VARCHAR AS ResponseCode, NULL::VARCHAR AS ResponseMessage FROM new""",
        BOOK,
        EARLY,
    )
    add(
        "m01_schedules",
        f"""SELECT {S_COLS.format(seats='(s.AvailableSeats - x.n)::INTEGER')} FROM Schedules s
JOIN (SELECT sched, count(*) AS n FROM sold GROUP BY sched) x ON x.sched = s.ScheduleID""",
        BOOK,
        EARLY,
    )
    add(
        "m01_rejects",
        """SELECT request_id, code::INTEGER AS code,
  CASE code WHEN 50001 THEN 'Lịch trình không tồn tại hoặc đã bị hủy.'
    ELSE 'Một trong các ghế đã được đặt.' END AS reason
FROM (SELECT request_id, coalesce(code, 50003) AS code FROM judged
  WHERE request_id NOT IN (SELECT request_id FROM new))""",
        BOOK,
        EARLY,
    )
    add(
        "m01_checked_bookings",
        """SELECT BookingID, 'BK19970109' || lpad((n + 69)::VARCHAR,
    greatest(5, length((n + 69)::VARCHAR))::INTEGER, '0') AS BookingCode, UserID,
  sched AS ScheduleID, TIMESTAMP '1997-01-09 08:30:00' AS BookingDate, total AS TotalAmount,
  'Pending' AS PaymentStatus, 'Active' AS BookingStatus, NULL::TIMESTAMP AS CancelledAt,
  NULL::VARCHAR AS CancellationReason FROM new""",
        CHECKED,
        EARLY,
    )
    add(
        "m01_checked_tickets",
        """SELECT (row_number() OVER (ORDER BY BookingID, pos))::VARCHAR AS TicketID,
  BookingID, SeatID, PassengerName, NULL::VARCHAR AS PassengerIDNumber,
  NULL::VARCHAR AS PassengerPhone, price AS TicketPrice, 'Valid' AS TicketStatus FROM sold""",
        CHECKED,
        EARLY,
    )
    add(
        "m01_checked_payments",
        """SELECT (SELECT max(PaymentID) FROM Payments) + n AS PaymentID, BookingID,
  method AS PaymentMethod, NULL::VARCHAR AS TransactionID, total AS Amount,
  TIMESTAMP '1997-01-09 08:30:00' AS PaymentDate, 'Pending' AS PaymentStatus,
  NULL::VARCHAR AS ResponseCode, NULL::VARCHAR AS ResponseMessage FROM new""",
        CHECKED,
        EARLY,
    )
    add(
        "m01_checked_schedules",
        f"""SELECT {S_COLS.format(seats='(s.AvailableSeats - x.n)::INTEGER')} FROM Schedules s
JOIN (SELECT sched, count(*) AS n FROM sold GROUP BY sched) x ON x.sched = s.ScheduleID""",
        CHECKED,
        EARLY,
    )
    add(
        "m01_checked_rejects",
        """SELECT request_id,
  CASE fault WHEN 'trip' THEN 50001 WHEN 'lists' THEN 50002 WHEN 'taken' THEN 50003 END::INTEGER AS code,
  CASE fault WHEN 'trip' THEN 'Lịch trình không tồn tại hoặc đã bị hủy.'
    WHEN 'late' THEN 'Không thể đặt vé cho chuyến tàu khởi hành trong vòng 2 giờ'
    WHEN 'lists' THEN 'Số lượng ghế và hành khách không khớp.'
    WHEN 'taken' THEN 'Một trong các ghế đã được đặt.'
    WHEN 'user' THEN 'unknown UserID' WHEN 'seat' THEN 'unknown SeatID'
    WHEN 'train' THEN 'seat of another train' WHEN 'method' THEN 'unknown PaymentMethod' END AS reason
FROM (SELECT request_id, coalesce(fault, 'taken') AS fault FROM judged
  WHERE request_id NOT IN (SELECT request_id FROM new))""",
        CHECKED,
        EARLY,
    )
    # the streams see the same rows as the batch jobs
    out["s03_bookings"] = out["m01_bookings"]
    out["s03_rejects"] = out["m01_rejects"]
    out["s01_payment_notices"] = out["m11_payment_notices"]
    out["s02_departure_reminders"] = out["m05_departure_reminders"]
    out["m11_payment_notices_per_row"] = out["m11_payment_notices"]
    told_at = _notice("Reminder", "'Nhắc nhở chuyến đi'", "text", "2000-01-01 00:00:00", "leaves - to_hours(2)")
    add(
        "s02_reminders_when_due",
        f"""SELECT UserID, BookingID, {told_at.replace("TIMESTAMP '2000-01-01 00:00:00'", "told")}
FROM (SELECT UserID, BookingID, text, leaves, CASE
    WHEN arrives >= opens AND arrives < opens + to_hours(23) THEN arrives
    WHEN arrives < opens AND opens <= clock THEN opens END AS told
  FROM (SELECT b.UserID, b.BookingID, b.BookingDate AS arrives, s.DepartureTime AS leaves, {text} AS text,
      date_trunc('hour', s.DepartureTime) - to_hours(24) AS opens,
      (SELECT max(BookingDate) - INTERVAL 90 SECOND FROM Bookings) AS clock
    FROM Bookings b JOIN Schedules s ON b.ScheduleID = s.ScheduleID JOIN Trains t ON s.TrainID = t.TrainID
    WHERE b.BookingStatus = 'Active' AND b.PaymentStatus = 'Paid' AND NOT EXISTS (SELECT 1
      FROM Notifications n WHERE n.BookingID = b.BookingID AND n.NotificationType = 'Reminder')))
WHERE told IS NOT NULL""",
        as_of=at,
    )
    add(
        "s03_first_claims",
        """SELECT ScheduleID, SeatID, ClaimedAt, BookingID FROM (SELECT *, row_number() OVER (
    PARTITION BY ScheduleID, SeatID ORDER BY ClaimedAt, BookingID) AS place FROM claims
  WHERE reason IS NULL) WHERE place = 1""",
        CLAIMS,
        EARLY,
    )
    add("s03_claim_rejects", "SELECT BookingID, code, reason FROM claims WHERE reason IS NOT NULL",
        CLAIMS, EARLY)
    add(
        "m03_cascade_tickets",
        f"""SELECT {T_COLS}, 'Cancelled' AS TicketStatus FROM Tickets tk
WHERE TicketStatus <> 'Cancelled' AND BookingID IN (SELECT BookingID FROM Bookings
  WHERE BookingStatus = 'Active' AND ScheduleID IN (SELECT ScheduleID FROM firsts))""",
        cancel_s,
    )
    add(
        "m04_new_payments",
        f"""SELECT (SELECT max(PaymentID) FROM Payments WHERE PaymentID % 7 <> 3) + n AS PaymentID,
  booking_id AS BookingID, NULL::VARCHAR AS PaymentMethod, last_try.txn AS TransactionID, amount AS Amount,
  CASE WHEN tries = 1 OR last_try.code = '00' THEN TIMESTAMP '{at}' END AS PaymentDate,
  CASE WHEN tries > 1 AND last_try.code = '00' THEN 'Success' ELSE 'Failed' END AS PaymentStatus,
  CASE WHEN tries = 1 THEN '99' ELSE last_try.code END AS ResponseCode,
  CASE WHEN tries = 1 THEN '{NO_PAYMENT}' WHEN last_try.code = '00' THEN 'Payment successful'
    ELSE 'Payment failed' END AS ResponseMessage
FROM (SELECT booking_id, any_value(amount) AS amount, count(*) AS tries,
    max_by({{'txn': txn, 'code': code}}, request_id) AS last_try,
    row_number() OVER (ORDER BY min(request_id)) AS n
  FROM good WHERE booking_id % 7 = 3 GROUP BY booking_id)""",
        PAY,
    )
    refused = out["m04_rejects"][0]
    add(
        "m04_unpaid_rejects",
        f"""{refused} UNION ALL SELECT min(request_id), 54003, '{NO_PAYMENT}' FROM good
WHERE booking_id % 7 = 3 GROUP BY booking_id""",
        PAY,
    )
    for table, key, code in (("Stations", "StationID", "StationCode"), ("Trains", "TrainID", "TrainCode"),
                             ("Routes", "RouteID", "RouteCode")):
        ranked = f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {code} ORDER BY request_id) AS nth
  FROM asked WHERE reason IS NULL)"""
        extra = NEW_MASTER[table] + "," + ranked
        add(
            f"m07_{table.lower()}",
            f"""SELECT (SELECT max({key}) FROM {table}) + row_number() OVER (ORDER BY request_id) AS {key},
  ranked.* EXCLUDE (request_id, reason, nth) FROM ranked WHERE nth = 1""",
            extra,
        )
        add(
            f"m07_{table.lower()}_rejects",
            """SELECT request_id, NULL::INTEGER AS code, reason FROM asked WHERE reason IS NOT NULL
UNION ALL SELECT request_id, NULL, 'an earlier row of the batch has this key' FROM ranked WHERE nth > 1""",
            extra,
        )
    for table, key, code in (("Stations", "StationID", "StationCode"), ("Trains", "TrainID", "TrainCode"),
                             ("Routes", "RouteID", "RouteCode")):
        # one by one: held is every row's code at the time
        moves = f"""
near AS MATERIALIZED (SELECT {key} AS k, {code} AS c, (SELECT min(p.{code}) FROM {table} p WHERE p.{key} = r.{key} - 1) AS before,
    (SELECT min(p.{code}) FROM {table} p WHERE p.{key} = r.{key} + 1) AS after FROM {table} r),
asked AS (SELECT k * 2 AS req, k, if(k % 7 = 0, NULL, if(k % 3 = 0, c || 'x', coalesce(before, c || 'y'))) AS code FROM near
  UNION ALL SELECT k * 2 + 1, k, coalesce(after, c || 'z') FROM near WHERE k % 3 = 0),
line AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY req) AS n FROM asked WHERE code IS NOT NULL),
steps(n, held, req, first) AS (
  SELECT 0::BIGINT, list({{'k': k, 'code': c, 'first': true}}), NULL::BIGINT, NULL::BOOLEAN FROM near
  UNION ALL
  SELECT l.n, CASE WHEN len(list_filter(s.held, lambda h: h.code = l.code AND h.k <> l.k)) > 0 THEN s.held
      ELSE list_append(list_filter(s.held, lambda h: h.k <> l.k), {{'k': l.k, 'code': l.code, 'first': false}}) END,
    CASE WHEN len(list_filter(s.held, lambda h: h.code = l.code AND h.k <> l.k)) > 0 THEN l.req END,
    list_filter(s.held, lambda h: h.code = l.code AND h.k <> l.k)[1].first
  FROM steps s JOIN line l ON l.n = s.n + 1)"""
        add(
            f"m08_{table.lower()}",
            f"""SELECT t.* REPLACE (coalesce(new.code, t.{code}) AS {code}) FROM {table} t LEFT JOIN (
  SELECT k, max_by(code, req) AS code FROM line WHERE req NOT IN (SELECT req FROM steps WHERE req IS NOT NULL)
  GROUP BY k) new ON new.k = t.{key}""",
            moves,
        )
        add(
            f"m08_{table.lower()}_rejects",
            f"""SELECT req AS request_id, NULL::INTEGER AS code, '{code} is missing' AS reason FROM asked WHERE code IS NULL
UNION ALL SELECT req, NULL, if(first, '{code} exists already', 'an earlier change of the batch has this key')
FROM steps WHERE req IS NOT NULL""",
            moves,
        )
    add(
        "m08_users_rejects",
        """SELECT request_id, NULL::INTEGER AS code, reason FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT request_id, NULL, if(at_start, 'Số điện thoại đã tồn tại trong hệ thống',
  'an earlier change of the batch has this key') FROM sound WHERE late""",
        USER_EDITS,
    )
    add(
        "m08_users_fixed",
        """SELECT u.UserID, coalesce(l.FullName, u.FullName) AS FullName, coalesce(l.Email, u.Email) AS Email,
  coalesce(l.PhoneNumber, u.PhoneNumber) AS PhoneNumber, u.UserType, u.IsActive, u.CreatedAt
FROM Users u LEFT JOIN (SELECT UserID, unnest(max_by({'FullName': FullName, 'Email': Email,
    'PhoneNumber': PhoneNumber}, request_id)) FROM sound WHERE NOT late GROUP BY UserID) l USING (UserID)""",
        USER_EDITS,
    )
    add(
        "m08_schedules_rejects",
        """SELECT BookingID AS request_id, NULL::INTEGER AS code, CASE BookingID % 7
    WHEN 0 THEN 'arrival is not after departure' WHEN 1 THEN 'BasePrice is missing'
    WHEN 2 THEN 'Status is not an allowed value' ELSE 'unknown RouteID' END AS reason
FROM Bookings WHERE BookingID % 7 < 4 AND ScheduleID IN (SELECT ScheduleID FROM Schedules)""",
    )
    for table, key, used, plain, why, when in (
        ("Users", "UserID", active, f"UserID % 3 = 0", "Cannot delete user with active bookings", at),
        ("Stations", "StationID", ends, "false", "Cannot delete station used in routes", at),
        ("Trains", "TrainID", soon, "false", "Cannot delete train with upcoming schedules",
         "2001-01-01 00:00:00"),
    ):
        add(
            f"m09_{table.lower()}_rejects",
            f"""SELECT {key} AS request_id, NULL::INTEGER AS code, CASE WHEN {key} IN ({used}) AND may
    THEN '{why}' ELSE 'Insufficient permissions' END AS reason
FROM (SELECT {key}, {key} % 3 = 1 AND 100 IN (SELECT UserID FROM Users
    WHERE UserType = 'Admin' AND IsActive) AS may FROM {table} WHERE NOT ({plain}))
WHERE NOT may OR {key} IN ({used})""",
            as_of=when,
        )
    add("m10_rejects", "SELECT ScheduleID, 'Không thể xóa chuyến tàu đã có đặt vé' AS reason FROM Schedules")
    add(
        "w01_appended_schedules",
        f"SELECT * FROM Schedules UNION ALL BY NAME ({out['m07_schedules'][0]})",
        NEW_SCHEDULES,
    )
    out["w02_updated_users"] = out["m08_users"]
    out["w02_updated_schedules"] = out["m08_schedules"]
    add(
        "w02_updated_bookings",
        f"""SELECT * FROM Bookings WHERE BookingID NOT IN (SELECT BookingID FROM hit)
UNION ALL BY NAME ({out['m02_bookings'][0]})""",
        cancel,
    )
    out["w03_remaining_schedules"] = out["m10_delete_free"]
    add(
        "view_scan",
        """SELECT Status, count(*) AS Trips, len(list_distinct(list(TrainID)))::BIGINT AS Trains
FROM Schedules SEMI JOIN (FROM Routes WHERE IsActive) USING (RouteID) GROUP BY Status""",
        as_of="2001-01-01 00:00:00",
    )
    return {n: with_tables(body, as_of, extra) for n, (body, as_of, extra) in out.items()}
