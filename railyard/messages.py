"""Reject reasons and notification texts."""

NO_RIGHTS = "Insufficient permissions"

# booking requests
NO_SCHEDULE = (50001, "Lịch trình không tồn tại hoặc đã bị hủy.")
LIST_MISMATCH = (50002, "Số lượng ghế và hành khách không khớp.")
SEAT_TAKEN = (50003, "Một trong các ghế đã được đặt.")
TOO_LATE = "Không thể đặt vé cho chuyến tàu khởi hành trong vòng 2 giờ"

# cancellations
NO_BOOKING_TO_CANCEL = (51001, "Booking không tồn tại.")
BOOKING_NOT_ACTIVE = (51002, "Booking không ở trạng thái Active.")
ALREADY_DEPARTED = (51003, "Chuyến tàu đã khởi hành, không thể hủy.")

# payments
NO_BOOKING_TO_PAY = (54001, "Booking không tồn tại.")
NOT_ACTIVE_TO_PAY = (54002, "Booking không ở trạng thái Active, không thể thanh toán.")
NO_PAYMENT = (54003, "Không tồn tại payment, kiểm tra lại thông tin booking!")
PAYMENT_OK = "Payment successful"
PAYMENT_FAILED = "Payment failed"

# master data
EMAIL_EXISTS = "Email đã tồn tại trong hệ thống"
PHONE_EXISTS = "Số điện thoại đã tồn tại trong hệ thống"
PASSWORD_TOO_SHORT = "Password must have at least 8 characters"
SAME_STATION = "Departure and arrival stations must be different"
USER_HAS_BOOKINGS = "Cannot delete user with active bookings"
STATION_IN_ROUTES = "Cannot delete station used in routes"
TRAIN_HAS_SCHEDULES = "Cannot delete train with upcoming schedules"
SCHEDULE_HAS_BOOKINGS = "Không thể xóa chuyến tàu đã có đặt vé"

# notification titles and texts
CANCELLED_TITLE = "Booking Cancelled"
CANCELLED_TEXT = ("Đặt vé #", " đã được hủy. Hoàn tiền: ", "%")
TRIP_CANCELLED_TITLE = "Chuyến tàu bị hủy"
TRIP_CANCELLED_TEXT = ("Chuyến tàu ", " đã bị hủy. Lý do: ")
PAID_TITLE = "Thanh toán thành công"
PAID_TEXT = ("Bạn đã thanh toán thành công ", "đ cho mã đặt vé ")
UNPAID_TITLE = "Thanh toán thất bại"
UNPAID_TEXT = ("Bạn đã thanh toán thất bại ", "đ cho mã đặt vé ")
REMINDER_TITLE = "Nhắc nhở chuyến đi"
REMINDER_TEXT = ("Chuyến tàu ", " của bạn sẽ khởi hành lúc ", ". Vui lòng có mặt trước 30 phút.")
