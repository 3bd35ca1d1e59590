"""Sample lines and their known outcome (fixed values)."""

ASA = [
    "%ASA-6-302013: Built inbound TCP connection 12345 for outside:10.0.0.1/1234 (10.0.0.1/1234) to inside:192.168.1.1/443 (192.168.1.1/443)",
    "%ASA-6-302014: Teardown TCP connection 12345 for outside:10.0.0.1/1234 to inside:192.168.1.1/443 duration 0:01:30 bytes 4567",
    "%ASA-4-106023: Deny tcp src outside:10.0.0.5/8080 dst inside:192.168.1.100/22",
    "%ASA-6-302013: Built outbound TCP connection 67890 for inside:192.168.1.50/55555 (192.168.1.50/55555) to outside:8.8.8.8/53 (8.8.8.8/53)",
    "%ASA-6-302014: Teardown UDP connection 99999 for outside:203.0.113.5/12345 to inside:10.0.0.10/514 duration 0:00:05 bytes 256",
]
SSHD = [
    "Sep  6 10:00:00 webserver sshd[12345]: Accepted password for admin from 192.168.1.100 port 52413 ssh2",
    "Sep  6 10:00:01 webserver sshd[12345]: Failed password for invalid user root from 10.0.0.5 port 44231 ssh2",
    "Sep  6 10:00:02 webserver sshd[12346]: Accepted publickey for deploy from 10.10.0.50 port 33221 ssh2",
    "Sep  6 10:00:03 webserver sshd[12347]: Failed password for admin from 192.168.1.200 port 60012 ssh2",
    "Sep  6 10:00:04 webserver sshd[12348]: Accepted password for sysadmin from 172.16.0.1 port 49876 ssh2",
]
SYSLOG = [
    '<134>1 2026-09-06T10:00:00.000Z myhost myapp 1234 ID47 [exampleSDID@32473 iut="3"] Application event occurred',
    "<165>1 2026-09-06T10:00:01.000Z router1 snmpd 5678 MSG001 - SNMP trap received from 10.0.0.1",
    "<86>1 2026-09-06T10:00:02.000Z firewall kernel - - - Firewall rule triggered for 192.168.1.1",
    "<13>Sep  6 10:00:03 legacyhost syslogd: restart",
    '<134>1 2026-09-06T10:00:04.000Z webserver nginx 9999 REQ123 [meta seq="1"] GET /api/health 200',
]
HASH_STARTS = [
    "8d2bf2335803", "bd886391d69c", "4ada0436569c", "d8d615084df8", "31841bba3d02",
    "9a3c576d5c4e", "a0438e6d913d", "edb399c27426", "b9f6116e9894", "2af1cc282f1b",
    "e95a06e04c07", "2d86e91ee56e", "c8a485a2437a", "2286f50a3d14", "a0842c45b6e1",
]
MIXED = [
    "Sep 10 23:14:02 ubuntu-server sshd[14534]: Failed password for root from 192.168.1.50 port 54321 ssh2",
    "Sep 10 23:14:05 ubuntu-server sshd[14534]: Accepted publickey for admin from 10.0.0.5 port 55555 ssh2: RSA SHA256:abcd1234efgh5678",
    "Sep 10 23:15:11 MacBook-Pro kernel[0]: ALF, IPFW: Stealth Mode connection attempt to UDP 192.168.1.100:5353 from 192.168.1.1:53",
    '{"timestamp":"2026-09-10 23:16:00.123","processID":456,"threadID":789,"subsystem":"com.apple.security","category":"auth","message":"User authentication failed for touchID"}',
    '%ASA-4-106023: Deny udp src outside:192.168.2.5/53 dst inside:10.0.0.2/5353 by access-group "outside_in"',
    "%ASA-6-302013: Built inbound TCP connection 123456 for outside:192.168.2.10/443 (192.168.2.10/443) to inside:10.0.0.5/54321 (10.0.0.5/54321)",
    '{"eventVersion": "1.08", "userIdentity": {"type": "IAMUser", "userName": "alice"}, "eventTime": "2026-09-10T23:18:00Z", "eventSource": "s3.amazonaws.com", "eventName": "DeleteBucket", "sourceIPAddress": "203.0.113.5", "userAgent": "aws-cli/2.0.0", "requestParameters": {"bucketName": "critical-prod-data"}}',
    '1,2026/09/10 23:20:00,00123456789,THREAT,vulnerability,1,2026/09/10 23:19:59,10.0.0.2,192.168.1.100,0.0.0.0,0.0.0.0,Rule1,admin,web-browsing,vsys1,trust,untrust,ethernet1/1,ethernet1/2,syslog,2026/09/10 23:20:00,12345,1,80,8080,0,0,0x400000,tcp,alert,"",Attempted Admin Privilege Gain(30001),any,informational,client-to-server,0,0x0,192.168.0.0-192.168.255.255,10.0.0.0-10.255.255.255,0,,0,,,0,,,,,,,,0,0,0,0,0',
]
MIXED_HASH_STARTS = ["a07f1ba4b0ae", "924c9e128552", "ac7e144bfe66", "e35c47c491a7", "44c14436bac6", "38421a1bcac1", "ac4599aea701", "2f49b063ab55"]
MIXED_STATUS = {
    "code": ["success", "success", "dlq", "dlq", "success", "success", "dlq", "dlq"],
    "instance": ["validation_error", "validation_error", "dlq", "dlq", "validation_error", "validation_error", "dlq", "dlq"],
}
