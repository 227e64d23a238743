"""Bronze shapes over the generic star-schema, event and text tables.

Each adapter is one declarative projection in the SQL subset shared by Spark and ANSI engines, so
the same definition feeds the models and their oracles. ``{name}`` stands for an input table.
"""
from __future__ import annotations

_YEAR = "2013 + CAST({k} % 3 AS INT)"


def _name_of(key: str, segment: str) -> str:
    """Account name of a customer row, with the awkward cases the user model has to handle."""
    return f"""CASE WHEN {key} % 11 = 0 THEN '  '
      WHEN {key} % 29 = 1 THEN 'glpi'
      WHEN {key} % 31 = 2 THEN 'Standard'
      WHEN {key} % 13 = 3 THEN 'PC' || CAST({key} AS STRING) || '$'
      WHEN {key} % 37 = 4 THEN 'mytest' || CAST({key} AS STRING)
      WHEN {key} % 41 = 5 THEN 'abc'
      WHEN {key} % 7 = 0 THEN lower({segment}) || CAST({key} AS STRING)
      ELSE lower({segment}) || '.' || CAST({key} AS STRING) END"""


def _uuid(key: str) -> str:
    """Two neighbouring machines share an identifier, every fifth pair has none."""
    return f"CASE WHEN {key} % 5 = 4 THEN NULL ELSE md5('hw' || CAST({key} - {key} % 2 AS STRING)) END"


def _host(key: str) -> str:
    """Machine of a component row, spread over all suppliers."""
    return f"{key} % (SELECT max(s_suppkey) + 1 FROM {{supplier}})"


BRONZE: dict[str, tuple[str, list[str]]] = {}


def _add(name: str, needs: str, sql: str) -> None:
    BRONZE[name] = (sql, needs.split())


_add("glpi_tickets", "orders lineitem", """
SELECT o.o_orderkey AS id,
  CASE WHEN o.o_orderkey % 50 = 7 THEN '0000-00-00 00:00:00' ELSE CAST(o.o_orderdate AS STRING) END AS date,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE CAST(l.first_ship AS STRING) END AS solvedate,
  CAST(l.last_ship AS STRING) AS closedate,
  CASE WHEN o.o_orderstatus = 'F' THEN 5 + CAST(o.o_orderkey % 2 AS INT)
       WHEN o.o_orderstatus = 'P' THEN 3 + CAST(o.o_orderkey % 2 AS INT)
       ELSE CAST(o.o_orderkey % 3 AS INT) END AS status,
  CASE WHEN o.o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS is_deleted,
  o.o_orderkey * 31 % 100000 - 500 AS waiting_duration,
  o.o_orderkey * 37 % 5000 - 1000 AS close_delay_stat,
  o.o_orderkey * 41 % 6000 - 2000 AS solve_delay_stat,
  o.o_orderkey * 43 % 7000 - 10 AS takeintoaccount_delay_stat,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE CAST(o.o_orderkey % 3 AS INT) END AS type,
  CASE WHEN o.o_orderkey % 10 = 9 THEN ' Printer ' WHEN o.o_orderkey % 10 = 8 THEN ' ' ELSE 'Computer' END AS itemtype,
  o.o_custkey % (SELECT max(s_suppkey) + 1 FROM {supplier}) AS items_id,
  o.o_orderkey % 9 - 1 AS itilcategories_id,
  CASE WHEN o.o_orderkey % 6 = 0 THEN ' - ' WHEN o.o_orderkey % 6 = 1 THEN NULL
       ELSE ' ' || o.o_orderpriority || ' ' END AS content,
  CASE WHEN o.o_orderkey % 47 = 0 THEN NULL ELSE 6 - CAST(substr(o.o_orderpriority, 1, 1) AS INT) END AS priority,
  CAST(o.o_orderkey % 6 AS INT) AS urgency,
  CAST(o.o_custkey % 7 AS INT) - 1 AS impact,
  year(o.o_orderdate) AS source_year,
  'GLPI' AS source_system
FROM {orders} o
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
           FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
""")
BRONZE["glpi_tickets"][1].append("supplier")

_add("glpi_users", "customer", f"""
SELECT c_custkey AS id, {_name_of("c_custkey", "c_mktsegment")} AS name,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'First' || CAST(c_custkey % 100 AS STRING) END AS firstname,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN ' ' ELSE c_name END AS realname,
  CASE WHEN c_custkey % 4 = 0 THEN 'CN=' || c_name || ',DC=corp' WHEN c_custkey % 4 = 1 THEN 'CN=' || c_name ELSE '' END AS user_dn,
  CASE WHEN c_custkey % 8 = 0 THEN md5(c_name) ELSE ' ' END AS personal_token,
  CASE WHEN c_custkey % 8 = 0 THEN '2015-03-0' || CAST(1 + c_custkey % 9 AS STRING) || ' 10:00:00'
       ELSE '0000-00-00 00:00:00' END AS personal_token_date,
  {_YEAR.format(k="c_custkey")} AS source_year, 'GLPI' AS source_system
FROM {{customer}}
""")

_add("glpi_ticketfollowups", "events", """
SELECT event_id AS id,
  CASE WHEN event_id % 3 = 0 THEN event_id % 101 ELSE event_id END AS tickets_id,
  CASE WHEN event_id % 53 = 0 THEN '0000-00-00 00:00:00' ELSE CAST(ts AS STRING) END AS date,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE user_id END AS users_id,
  event_id % 4 AS requesttypes_id,
  CASE event_type WHEN 'click' THEN 'see http://kb/' || props WHEN 'error' THEN ' -- '
       WHEN 'view' THEN props || '<br />&nbsp;&gt; réseau' WHEN 'signup' THEN NULL
       ELSE 'url http' END AS content,
  CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN 1 ELSE 0 END AS is_private,
  2013 + CAST(event_id % 3 AS INT) AS source_year, 'GLPI' AS source_system
FROM {events}
""")

_add("glpi_logs", "events customer", f"""
SELECT e.event_id AS id, e.user_id % 40 AS items_id,
  CASE WHEN e.event_id % 12 = 0 THEN ' ' ELSE e.event_type END AS itemtype,
  '' AS itemtype_link, CAST(e.event_id % 20 AS STRING) AS linked_action,
  CASE WHEN e.event_id % 4 = 0 THEN upper(u.account) ELSE u.account END AS user_name,
  CAST(e.ts AS STRING) AS date_mod, CAST(e.event_id % 90 AS INT) AS id_search_option,
  CASE CAST(e.event_id % 6 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'v1' WHEN 2 THEN ' v1 ' WHEN 3 THEN 'v1'
       WHEN 4 THEN '-' ELSE '' END AS old_value,
  CASE CAST(e.event_id % 6 AS INT) WHEN 0 THEN 'v2' WHEN 1 THEN NULL WHEN 2 THEN 'v1' WHEN 3 THEN 'v2'
       WHEN 4 THEN 'v2' ELSE '-' END AS new_value,
  2013 + CAST(e.event_id % 3 AS INT) AS source_year, 'GLPI' AS source_system
FROM {{events}} e
LEFT JOIN (SELECT c_custkey, {_name_of("c_custkey", "c_mktsegment")} AS account FROM {{customer}}) u
  ON u.c_custkey = e.user_id
""")

_add("glpi_computers", "supplier", f"""
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE {_uuid("s_suppkey")} END AS uuid,
  CASE WHEN s_suppkey % 4 = 1 THEN 'other-' || s_name ELSE upper(s_name) END AS name,
  CASE WHEN s_suppkey % 33 = 5 THEN 1 ELSE 0 END AS is_template,
  CASE WHEN s_suppkey % 27 = 6 THEN 1 ELSE 0 END AS is_deleted,
  CAST(s_suppkey % 2 AS INT) AS is_ocs_import, s_nationkey AS manufacturers_id, s_suppkey % 60 AS users_id,
  s_suppkey % 5 AS groups_id, {_YEAR.format(k="s_suppkey")} AS source_year, 'GLPI' AS source_system
FROM {{supplier}}
""")

_add("glpi_infocoms", "supplier", f"""
SELECT s_suppkey AS id, s_suppkey AS items_id,
  CASE WHEN s_suppkey % 9 = 8 THEN 'NetworkEquipment' ELSE 'Computer' END AS itemtype, s_nationkey AS entities_id,
  CASE WHEN s_suppkey % 10 = 3 THEN 0.0E0 ELSE s_acctbal END AS value,
  CASE WHEN s_suppkey % 10 = 4 THEN NULL ELSE round(s_acctbal / 8, 3) END AS warranty_value,
  CASE WHEN s_suppkey % 6 = 2 THEN '0000-00-00' WHEN s_suppkey % 6 = 3 THEN NULL
       ELSE CAST(2005 + s_suppkey % 18 AS STRING) || '-02-1' || CAST(s_suppkey % 10 AS STRING) END AS buy_date,
  CASE WHEN s_suppkey % 4 = 2 THEN '0000-00-00' WHEN s_suppkey % 4 = 3 THEN NULL
       ELSE CAST(2010 + s_suppkey % 18 AS STRING) || '-07-01' END AS warranty_date,
  {_YEAR.format(k="s_suppkey")} AS source_year, 'GLPI' AS source_system
FROM {{supplier}}
""")

_add("glpi_itilcategories", "part", f"""
SELECT p_partkey AS id,
  CASE CAST(p_partkey % 10 AS INT) WHEN 0 THEN 'Réseau ' || p_name WHEN 1 THEN 'Hardware' WHEN 2 THEN 'LOGICIEL'
       WHEN 3 THEN 'Sécurité' WHEN 4 THEN 'Imprimante' WHEN 5 THEN ' Mail ' WHEN 6 THEN 'vpn' WHEN 7 THEN ' '
       WHEN 8 THEN NULL ELSE p_name END AS name,
  p_type || ' > ' || p_name AS completename,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 4 - 1 END AS itilcategories_id,
  CASE WHEN p_size % 7 = 6 THEN NULL ELSE p_size % 7 END AS level,
  CAST(p_partkey % 2 AS INT) AS is_helpdeskvisible,
  {_YEAR.format(k="p_partkey")} AS source_year, 'GLPI' AS source_system
FROM {{part}}
""")

_add("glpi_deviceprocessors", "part", f"""
SELECT p_partkey AS id,
  CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN 'Intel Core i7 x64 [4 core(s)]' WHEN 1 THEN 'INTEL XEON 64-bit [12 core(s)]'
       WHEN 2 THEN 'AMD Ryzen 5 x86' WHEN 3 THEN 'Core(TM)2 Duo' WHEN 4 THEN 'Atom [1 core' WHEN 5 THEN NULL
       WHEN 6 THEN 'Pentium ' || p_brand ELSE p_name || ' ' || p_type END AS designation,
  CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_size % 10 * 1300 END AS specif_default,
  {_YEAR.format(k="p_partkey")} AS source_year, 'GLPI' AS source_system
FROM {{part}}
""")

_add("glpi_devicememories", "part", f"""
SELECT p_partkey AS id,
  CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN 'ddr4 ECC' WHEN 1 THEN 'DDR3 No ECC' WHEN 2 THEN 'DDR2' WHEN 3 THEN 'FLASH'
       WHEN 4 THEN 'SDRAM' WHEN 5 THEN NULL WHEN 6 THEN 'DDR3' ELSE p_name END AS designation,
  CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN '0' ELSE CAST(p_size * 150 AS STRING) || ' MHz' END AS frequence,
  CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_size % 8 * 2560 - 2560 END AS specif_default,
  {_YEAR.format(k="p_partkey")} AS source_year, 'GLPI' AS source_system
FROM {{part}}
""")

_add("glpi_devicegraphiccards", "part", f"""
SELECT p_partkey AS id,
  CASE CAST(p_partkey % 11 AS INT) WHEN 0 THEN 'NVIDIA GeForce' WHEN 1 THEN 'geforce 8' WHEN 2 THEN ' Intel HD '
       WHEN 3 THEN 'Radeon XPRESS' WHEN 4 THEN '4' WHEN 5 THEN 'Contrôleur VGA' WHEN 6 THEN NULL WHEN 7 THEN 'Matrox G200'
       WHEN 8 THEN 'Microsoft Basic Render Driver' WHEN 9 THEN 'Microsoft Hyper-V' ELSE p_name END AS designation,
  CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_size % 6 * 1024 - 1024 END AS specif_default,
  {_YEAR.format(k="p_partkey")} AS source_year, 'GLPI' AS source_system
FROM {{part}}
""")

_add("ocs_hardware", "supplier lineitem customer", f"""
SELECT s.s_suppkey AS ID, ' dev-' || CAST(s.s_suppkey AS STRING) AS DEVICEID, s.s_name || ' ' AS NAME, 'WORKGROUP' AS WORKGROUP,
  '' AS USERDOMAIN, u.account AS USERID,
  CASE CAST(s.s_nationkey % 6 AS INT) WHEN 0 THEN 'Microsoft Windows 7' WHEN 1 THEN 'Ubuntu 20' WHEN 2 THEN 'Debian'
       WHEN 3 THEN 'macOS' WHEN 4 THEN NULL ELSE 'Solaris' END AS OSNAME,
  '6.1' AS OSVERSION, ' ' AS OSCOMMENTS, 'Xeon' AS PROCESSORT, 1 AS PROCESSORS, CAST(s.s_suppkey % 12 AS INT) AS PROCESSORN,
  s.s_suppkey * 700 % 32768 - 700 AS MEMORY, s.s_suppkey * 300 % 9000 - 300 AS SWAP,
  CASE WHEN s.s_suppkey % 4 = 0 THEN '10.0.0' ELSE '10.0.0.' || CAST(s.s_suppkey % 250 AS STRING) END AS IPADDR,
  '' AS DNS, '10.0.0.1' AS DEFAULTGATEWAY, '' AS IPSRC, CAST(NULL AS STRING) AS ETIME,
  CASE WHEN s.s_suppkey % 14 = 0 THEN NULL ELSE l.first_ship END AS LASTDATE,
  CASE WHEN s.s_suppkey % 15 = 1 THEN NULL ELSE l.last_ship END AS LASTCOME,
  CAST(s.s_suppkey % 101 AS DOUBLE) AS QUALITY, s.s_suppkey % 7 AS FIDELITY, '' AS WINCOMPANY, 'owner' AS WINOWNER,
  '' AS WINPRODID, CASE WHEN s.s_suppkey % 3 = 0 THEN 'KEY' ELSE ' ' END AS WINPRODKEY, 'agent' AS USERAGENT,
  s.s_suppkey * 17 AS CHECKSUM, '0' AS SSTATE, {_uuid("s.s_suppkey")} AS UUID,
  CASE CAST(s.s_suppkey % 4 AS INT) WHEN 0 THEN 'amd64' WHEN 1 THEN 'X86' WHEN 2 THEN NULL ELSE 'arm' END AS ARCH,
  {_YEAR.format(k="s.s_suppkey")} AS source_year, 'OCS' AS source_system
FROM {{supplier}} s
LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM {{lineitem}}
           GROUP BY l_suppkey) l ON l.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT c_custkey, {_name_of("c_custkey", "c_mktsegment")} AS account FROM {{customer}}) u
  ON u.c_custkey = s.s_suppkey * 3
""")

_add("ocs_bios", "supplier", f"""
SELECT s_suppkey AS HARDWARE_ID,
  CASE CAST(s_suppkey % 7 AS INT) WHEN 0 THEN 'Hewlett-Packard' WHEN 1 THEN 'DELL Inc.' WHEN 2 THEN 'Lenovo' WHEN 3 THEN 'FOXCONN'
       WHEN 4 THEN 'Micro-Star' WHEN 5 THEN ' ' ELSE 'Acme' END AS SMANUFACTURER,
  s_name AS SMODEL,
  CASE CAST(s_suppkey % 6 AS INT) WHEN 0 THEN 'OEM_Serial' WHEN 1 THEN '12345678' WHEN 2 THEN NULL WHEN 3 THEN ' '
       ELSE ' SN' || CAST(s_suppkey AS STRING) END AS SSN,
  CASE CAST(s_suppkey % 6 AS INT) WHEN 0 THEN 'Notebook' WHEN 1 THEN 'Mini Tower' WHEN 2 THEN 'Rack Server' WHEN 3 THEN NULL
       WHEN 4 THEN 'Desktop' ELSE 'Blade' END AS TYPE,
  'AMI' AS BMANUFACTURER,
  CASE CAST(s_suppkey % 4 AS INT) WHEN 0 THEN 'A01 ; x' WHEN 1 THEN ' B2 ' WHEN 2 THEN NULL ELSE '' END AS BVERSION,
  CASE CAST(s_suppkey % 8 AS INT) WHEN 0 THEN '31/12/2010' WHEN 1 THEN '12/31/2015' WHEN 2 THEN '05/06/2020'
       WHEN 3 THEN '13/13/2010' WHEN 4 THEN '2010-01-01' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE '02/03/2023' END AS BDATE,
  CASE CAST(s_suppkey % 4 AS INT) WHEN 0 THEN 'No Asset Tag' WHEN 1 THEN 'to be filled by O.E.M.' WHEN 2 THEN NULL
       ELSE ' TAG' || CAST(s_suppkey AS STRING) END AS ASSETTAG,
  {_YEAR.format(k="s_suppkey")} AS source_year, 'OCS' AS source_system
FROM {{supplier}}
""")

_add("ocs_drives", "part supplier", f"""
SELECT p_partkey AS ID, {_host("p_partkey")} AS HARDWARE_ID,
  CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE 'c:' END AS LETTER,
  CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'Fixed Drive' WHEN 1 THEN 'Local' WHEN 2 THEN 'CD-Rom' WHEN 3 THEN NULL
       WHEN 4 THEN 'Removable' ELSE 'Hard drive' END AS TYPE,
  'ntfs' AS FILESYSTEM,
  CASE WHEN p_size % 10 = 0 THEN 0 WHEN p_size % 10 = 1 THEN NULL ELSE p_size * 20000 END AS TOTAL,
  CASE WHEN p_size % 10 = 2 THEN NULL WHEN p_size % 10 = 3 THEN -5 ELSE CAST(p_partkey % (p_size * 20000) AS INT) END AS FREE,
  CAST(p_partkey % 100 AS BIGINT) - 3 AS NUMFILES, ' ' AS VOLUMN, '2014-01-01' AS CREATEDATE,
  {_YEAR.format(k="(" + _host("p_partkey") + ")")} AS source_year, 'OCS' AS source_system
FROM {{part}}
""")

_add("ocs_memories", "part supplier", f"""
SELECT p_partkey AS ID, {_host("p_partkey")} AS HARDWARE_ID, p_name AS CAPTION, '' AS DESCRIPTION,
  CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN '0' WHEN 1 THEN '256' WHEN 2 THEN '257' WHEN 3 THEN '4096' WHEN 4 THEN '1000000000'
       WHEN 5 THEN '17179869184' WHEN 6 THEN 'abc' WHEN 7 THEN ' ' ELSE NULL END AS CAPACITY,
  'System' AS PURPOSE, CASE WHEN p_partkey % 4 = 0 THEN 'DDR3' WHEN p_partkey % 4 = 1 THEN 'sdram' WHEN p_partkey % 4 = 2 THEN NULL
       ELSE p_type END AS TYPE,
  CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN '0' WHEN 1 THEN '1600' WHEN 2 THEN '3200 MHz' WHEN 3 THEN ' ' ELSE NULL END AS SPEED,
  CAST(p_partkey % 5 AS INT) - 1 AS NUMSLOTS,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN '00000000' WHEN 1 THEN 'SerNum' WHEN 2 THEN NULL
       ELSE ' M' || CAST(p_partkey AS STRING) END AS SERIALNUMBER,
  {_YEAR.format(k="(" + _host("p_partkey") + ")")} AS source_year, 'OCS' AS source_system
FROM {{part}}
""")

_add("ocs_networks", "part supplier", f"""
SELECT p_partkey AS ID, {_host("p_partkey")} AS HARDWARE_ID, p_name AS DESCRIPTION,
  CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'Ethernet' WHEN 1 THEN 'WiFi' WHEN 2 THEN 'Wireless LAN' WHEN 3 THEN NULL
       WHEN 4 THEN 'VPN adapter' ELSE 'Dialup' END AS TYPE,
  '' AS TYPEMIB,
  CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN '1000000000' WHEN 1 THEN '100000000' WHEN 2 THEN '54000000' WHEN 3 THEN '0'
       WHEN 4 THEN ' ' ELSE NULL END AS SPEED,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'aa:bb:' || CAST(p_partkey AS STRING) END AS MACADDR,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'Up' WHEN 1 THEN 'Disconnected' WHEN 2 THEN NULL ELSE 'idle' END AS STATUS,
  CASE WHEN p_partkey % 3 = 0 THEN 'a.b.c.d' ELSE '999.1.1.' || CAST(p_partkey % 250 AS STRING) END AS IPADDRESS,
  '255.255.255.0' AS IPMASK, '' AS IPGATEWAY, '' AS IPSUBNET,
  CASE WHEN p_partkey % 2 = 0 THEN '10.0.0.2' ELSE ' ' END AS IPDHCP, CAST(p_partkey % 3 AS INT) AS VIRTUALDEV,
  {_YEAR.format(k="(" + _host("p_partkey") + ")")} AS source_year, 'OCS' AS source_system
FROM {{part}}
""")

_add("ocs_software", "lineitem part", f"""
SELECT l.l_partkey AS ID, l.l_suppkey AS HARDWARE_ID, p.p_brand AS PUBLISHER,
  CASE CAST(l.l_partkey % 12 AS INT) WHEN 0 THEN 'Java 6 update' WHEN 1 THEN 'Adobe Flash' WHEN 2 THEN 'Windows XP tools'
       WHEN 3 THEN 'MS Office' WHEN 4 THEN 'Firefox' WHEN 5 THEN 'McAfee Security' WHEN 6 THEN 'MySQL' WHEN 7 THEN NULL
       WHEN 8 THEN 'VirtualBox' ELSE p.p_name END AS NAME,
  CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_size AS STRING) END AS VERSION, '' AS FOLDER, ' ' AS COMMENTS,
  'a.exe' AS FILENAME, CAST(p.p_size - 1 AS BIGINT) * 100 AS FILESIZE, CAST(p.p_size % 3 AS INT) AS SOURCE,
  CASE WHEN l.l_partkey % 3 = 0 THEN md5(p.p_name) ELSE '' END AS GUID, 'en' AS LANGUAGE,
  CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE '2014-05-01' END AS INSTALLDATE,
  CASE CAST(l.l_partkey % 3 AS INT) WHEN 0 THEN 64 WHEN 1 THEN 32 ELSE NULL END AS BITSWIDTH,
  {_YEAR.format(k="l.l_suppkey")} AS source_year, 'OCS' AS source_system
FROM {{lineitem}} l JOIN {{part}} p ON p.p_partkey = l.l_partkey
""")

_add("ocs_storages", "part supplier", f"""
SELECT p_partkey AS ID, {_host("p_partkey")} AS HARDWARE_ID,
  CASE CAST(p_partkey % 8 AS INT) WHEN 0 THEN 'Seagate' WHEN 1 THEN 'WDC' WHEN 2 THEN 'SAMSUNG' WHEN 3 THEN 'Toshiba'
       WHEN 4 THEN 'Kingston' WHEN 5 THEN NULL WHEN 6 THEN ' ' ELSE p_brand END AS MANUFACTURER,
  p_name AS NAME, CASE WHEN p_partkey % 5 = 0 THEN 'NVMe x' WHEN p_partkey % 5 = 1 THEN NULL ELSE p_brand END AS MODEL,
  CASE WHEN p_partkey % 4 = 0 THEN 'Hard Disk' ELSE '' END AS DESCRIPTION,
  CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'SSD' WHEN 1 THEN 'SATA' WHEN 2 THEN 'SAS' WHEN 3 THEN NULL WHEN 4 THEN 'SCSI'
       ELSE 'HDD' END AS TYPE,
  CAST(p_size - 1 AS BIGINT) * 30000 AS DISKSIZE,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'None' WHEN 1 THEN 'unknown' WHEN 2 THEN NULL
       ELSE ' D' || CAST(p_partkey AS STRING) END AS SERIALNUMBER,
  CASE WHEN p_partkey % 2 = 0 THEN 'F1' ELSE '' END AS FIRMWARE,
  {_YEAR.format(k="(" + _host("p_partkey") + ")")} AS source_year, 'OCS' AS source_system
FROM {{part}}
""")

_add("cve_data", "part", """
SELECT p_partkey AS unnamed_0, CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS cwe_code,
  p_type AS cwe_name, CASE WHEN p_size % 8 = 0 THEN ' ' ELSE p_name END AS summary,
  CASE WHEN p_partkey % 25 = 0 THEN ' ' ELSE '2019-05-0' || CAST(1 + p_partkey % 9 AS STRING) || ' 10:00:00' END AS pub_date,
  CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE '2019-11-1' || CAST(p_partkey % 10 AS STRING) || ' 12:00:00' END AS mod_date,
  CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE CAST(p_partkey * 7 % 130 AS DOUBLE) / 10 - 1 END AS cvss,
  'NONE' AS access_authentication,
  CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'LOW' WHEN 1 THEN 'HIGH' ELSE NULL END AS access_complexity,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'NETWORK' WHEN 1 THEN 'Local' WHEN 2 THEN '' ELSE NULL END AS access_vector,
  'PARTIAL' AS impact_availability, 'NONE' AS impact_confidentiality, 'COMPLETE' AS impact_integrity
FROM {part}
""")

_add("harddrive_data", "lineitem", """
SELECT 'SN' || CAST(l_partkey AS STRING) AS serial_number, CASE WHEN l_partkey % 6 = 0 THEN ' ' ELSE 'ST' || CAST(l_suppkey AS STRING) END AS model,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS date,
  CASE WHEN l_linenumber = 7 THEN -1 ELSE CAST(l_linenumber AS BIGINT) * 500107862016 END AS capacity_bytes,
  CASE WHEN l_tax >= 0.08 THEN 1 ELSE 0 END AS failure,
  CASE WHEN l_discount > 0.08 THEN l_quantity WHEN l_discount < 0.02 THEN NULL ELSE 0.0E0 END AS smart_5_raw,
  l_quantity * 100 AS smart_9_raw, CAST(0 AS DOUBLE) AS smart_187_raw, CAST(0 AS DOUBLE) AS smart_188_raw,
  20 + l_quantity % 25 AS smart_194_raw,
  CASE WHEN l_tax < 0.01 THEN l_quantity ELSE 0.0E0 END AS smart_197_raw,
  CASE WHEN l_tax = 0.03 THEN NULL ELSE 0.0E0 END AS smart_198_raw,
  CASE WHEN l_returnflag = 'R' THEN 1.0E0 ELSE 0.0E0 END AS smart_199_raw
FROM {lineitem}
""")

_add("windows_eventlog_data", "events", """
SELECT event_id AS unnamed_0, 'PC' || CAST(user_id AS STRING) AS MachineName, upper(event_type) AS Category,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'click' THEN 'Warning' WHEN 'signup' THEN 'Failure Audit'
       WHEN 'view' THEN 'Success Audit' ELSE NULL END AS EntryType,
  CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'Logon FAILED ' || props WHEN 1 THEN 'Access denied' WHEN 2 THEN NULL
       ELSE 'ok ' || props END AS Message,
  CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'Security-Auditing' WHEN 1 THEN 'System' WHEN 2 THEN 'Application Error'
       WHEN 3 THEN 'Network' ELSE ' ' END AS Source,
  CASE WHEN event_id % 60 = 0 THEN ' ' ELSE CAST(date_trunc('second', ts) AS STRING) END AS TimeGenerated,
  'France' AS country, 'IDF' AS regionName, ' Paris' AS city, '75001' AS zip, 'UTC' AS timezone, 'isp' AS isp
FROM {events}
""")

_add("laptop_price_data", "part", """
SELECT p_partkey AS laptop_ID, p_brand AS Company, p_name AS Product, p_type AS TypeName, 15.6E0 AS Inches,
  CASE WHEN p_partkey % 3 = 0 THEN 'IPS Panel Touchscreen' WHEN p_partkey % 3 = 1 THEN 'Full HD' ELSE NULL END AS ScreenResolution,
  CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 'Core i7' WHEN 1 THEN 'core i5' WHEN 2 THEN 'AMD Ryzen 7' WHEN 3 THEN 'Celeron' ELSE 'Atom' END AS Cpu,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS STRING) || 'GB' END AS Ram,
  CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN '256GB SSD' WHEN 1 THEN '1TB HDD' ELSE '128GB SSD + 1TB HDD' END AS Memory,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'Nvidia GTX' WHEN 1 THEN 'AMD R5' WHEN 2 THEN 'Intel HD' ELSE NULL END AS Gpu,
  'Windows 10' AS OpSys, CASE WHEN p_size % 7 = 0 THEN NULL ELSE '1.' || CAST(p_size AS STRING) || 'kg' END AS Weight,
  CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_retailprice END AS Price_euros
FROM {part}
""")

_add("support_tickets", "orders customer", """
SELECT CAST(o.o_orderkey AS STRING) AS ticket_id, c.c_name AS customer_name, upper(c.c_name) || '@corp.example' AS customer_email,
  c.c_mktsegment AS customer_segment, CAST(20 + c.c_custkey % 60 AS INT) AS customer_age, 'F' AS customer_gender,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'Pro' ELSE ' ' END AS subscription_type,
  CASE WHEN o.o_orderkey % 12 = 0 THEN NULL ELSE CAST(c.c_custkey % 70 AS INT) END AS customer_tenure_months,
  CAST(o.o_custkey % 13 AS INT) AS previous_tickets,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(o.o_orderkey % 11 AS DOUBLE) / 2 END AS customer_satisfaction_score,
  'Product' || CAST(o.o_orderkey % 5 AS STRING) AS product, 'Category ' || CAST(o.o_orderkey % 7 AS STRING) AS category,
  'Issue with ' || o.o_orderpriority AS issue_description,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Resolved by restart of ' || c.c_mktsegment ELSE NULL END AS resolution_notes,
  CASE CAST(o.o_orderkey % 5 AS INT) WHEN 0 THEN 'Urgent' WHEN 1 THEN 'High' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'low' ELSE NULL END AS priority,
  CASE CAST(o.o_orderkey % 6 AS INT) WHEN 0 THEN 'Closed' WHEN 1 THEN 'Resolved' WHEN 2 THEN 'In Progress' WHEN 3 THEN 'Open'
       WHEN 4 THEN 'Escalated' ELSE 'Other' END AS status,
  'Email' AS channel, 'EU' AS region, 'EN' AS language, 'card' AS payment_method, '' AS preferred_contact_time,
  'Windows' AS operating_system, 'Edge' AS browser, CAST(o.o_orderkey % 30 AS DOUBLE) AS first_response_time_hours,
  CAST(o.o_orderkey % 300 AS DOUBLE) AS resolution_time_hours,
  CASE WHEN o.o_orderkey % 8 = 0 THEN NULL ELSE CAST(o.o_orderkey % 10 AS DOUBLE) END AS issue_complexity_score,
  CASE CAST(o.o_orderkey % 4 AS INT) WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN NULL ELSE '1' END AS escalated,
  CASE CAST(o.o_orderkey % 3 AS INT) WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'false' ELSE '0' END AS sla_breached,
  CASE WHEN o.o_orderkey % 44 = 0 THEN ' ' ELSE CAST(o.o_orderdate AS STRING) END AS ticket_created_date,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(o.o_orderdate + INTERVAL 3 DAY AS STRING) END AS ticket_resolved_date,
  'customer_support' AS source_dataset
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
""")

_add("multilang_tickets", "documents", """
SELECT split_part(text, chr(10), 1) AS subject, text AS body,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'answer for ' || source END AS answer,
  CASE WHEN doc_id % 2 = 0 THEN 'Incident' ELSE 'Request' END AS type, source AS queue,
  CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN 'high' WHEN 1 THEN 'Medium' ELSE 'low' END AS priority,
  upper(lang) AS language, CAST(doc_id % 5 AS STRING) AS version, source AS tag_1, lang AS tag_2, ' ' AS tag_3,
  CAST(NULL AS STRING) AS tag_4, CAST(NULL AS STRING) AS tag_5, CAST(NULL AS STRING) AS tag_6,
  CAST(NULL AS STRING) AS tag_7, CAST(NULL AS STRING) AS tag_8, 'multi_lang' AS source_dataset
FROM {documents}
""")

# Real ticket texts with the scores and levels that the gold corpus carries; every tenth row is
# synthetic context and every eleventh a repeat of the previous ticket key.
_add("ticket_texts", "documents", """
SELECT md5('SIM_' || CAST(doc_id AS STRING)) AS similarity_pk,
  'T' || CAST(doc_id - CASE WHEN doc_id % 11 = 10 THEN 1 ELSE 0 END AS STRING) AS ticket_pk,
  doc_id, source AS source_system, lang AS language, text AS text_corpus, source || ' prio_high urg_low' AS synthetic_text_corpus,
  CASE WHEN doc_id % 10 = 9 THEN 'synthetic_context' ELSE 'real_text' END AS text_source_type,
  CASE WHEN doc_id % 10 = 9 THEN 'synthetic_context' ELSE 'nlp_embedding' END AS similarity_method,
  CASE WHEN doc_id % 10 = 9 THEN 0.7E0 ELSE 1.0E0 END AS corpus_quality_score,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 0.9E0 END AS similarity_confidence,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 2 + CAST(doc_id % 4 AS INT) END AS priority_encoded,
  CASE WHEN doc_id % 5 = 1 THEN NULL ELSE 2 + CAST(doc_id % 3 AS INT) END AS urgency_encoded,
  CASE WHEN doc_id % 6 = 1 THEN NULL ELSE 3 + CAST(doc_id % 3 AS INT) END AS impact_encoded
FROM {documents}
""")
