"""roomtide: live-room engagement analytics as Spark jobs."""
